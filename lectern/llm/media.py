"""Ogg media columns: pages with checksums, packets from lacing values, logical streams, granule timestamps."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.tables import small_batches

# Fixed values of the Ogg bitstream format (RFC 3533).
CAPTURE = b"OggS"
CONTINUED, FIRST, LAST = 1, 2, 4
NO_GRANULE = -1

#: Samples a second of the audio stream and samples in a packet; both are written to its header packet.
RATE = 8000
PACKET = 4096
MAGIC_AUDIO, MAGIC_NOTES = b"\x7fpcm-u8\x00", b"\x7fnotes\x00\x00"

_FLIP = bytes(int(f"{x:08b}"[::-1], 2) for x in range(256))


def page_crc(page: bytes) -> int:
    """Ogg's CRC-32: polynomial 0x04c11db7, most significant bit first, no inversions.

    It is zlib's CRC of the bit-reversed bytes, with zlib's two inversions undone, bit-reversed.
    """
    crc = zlib.crc32(page.translate(_FLIP), 0xFFFFFFFF) ^ 0xFFFFFFFF
    return int.from_bytes(crc.to_bytes(4, "little").translate(_FLIP), "big")


class Writer:
    """Pages of one logical stream."""

    def __init__(self, serial: int):
        self.serial, self.number = serial, 0

    def pages(self, packets: list[bytes], granules: list[int], flags: int = 0) -> Iterator[bytes]:
        """Whole packets to pages of at most 255 lacing values; flags: FIRST for the first page, LAST for the last."""
        body, lacing, granule, going_on, ready = bytearray(), [], NO_GRANULE, False, []
        for packet, at in zip(packets, granules, strict=True):
            values = [255] * (len(packet) // 255) + [len(packet) % 255]
            done = 0
            for i, value in enumerate(values):
                if len(lacing) == 255:
                    ready.append((going_on, granule, lacing, bytes(body)))
                    body, lacing, granule, going_on = bytearray(), [], NO_GRANULE, i > 0
                lacing.append(value)
                body += packet[done : done + value]
                done += value
            granule = at
        ready.append((going_on, granule, lacing, bytes(body)))
        for i, (cont, at, values, data) in enumerate(ready):
            kind = CONTINUED * cont | flags & FIRST * (i == 0) | flags & LAST * (i == len(ready) - 1)
            yield self._page(kind, at, values, data)

    def _page(self, kind: int, granule: int, lacing: list[int], body: bytes) -> bytes:
        head = struct.pack("<4sBBqIIIB", CAPTURE, 0, kind, granule, self.serial, self.number, 0, len(lacing)) + bytes(lacing)
        self.number += 1
        return head[:22] + struct.pack("<I", page_crc(head + body)) + head[26:] + body


class Corrupt(ValueError):
    """A page or packet that breaks the format."""


def read_pages(media: bytes) -> Iterator[tuple[int, int, int, int, bytes, bytes]]:
    """(flags, granule, serial, number, lacing values, body) of each page; raises Corrupt at a bad one."""
    at = 0
    while at < len(media):
        if len(media) - at < 27 or media[at : at + 4] != CAPTURE:
            raise Corrupt(f"no page at byte {at}")
        _, version, kind, granule, serial, number, crc, n = struct.unpack_from("<4sBBqIIIB", media, at)
        lacing = media[at + 27 : at + 27 + n]
        end = at + 27 + n + sum(lacing)
        if version or len(lacing) < n or end > len(media):
            raise Corrupt(f"cut or unknown page at byte {at}")
        if page_crc(media[at : at + 22] + b"\0\0\0\0" + media[at + 26 : end]) != crc:
            raise Corrupt(f"checksum of the page at byte {at}")
        yield kind, granule, serial, number, lacing, media[at + 27 + n : end]
        at = end


def demultiplex(media: bytes) -> dict[int, list[tuple[bytes, int]]]:
    """Packets of each logical stream, by serial number, with the granule position of each (-1: none ends its page)."""
    streams: dict[int, list[tuple[bytes, int]]] = {}
    parts: dict[int, bytearray] = {}
    numbers: dict[int, int] = {}
    ended: set[int] = set()
    for kind, granule, serial, number, lacing, body in read_pages(media):
        if bool(kind & FIRST) == (serial in numbers) or serial in ended:
            raise Corrupt(f"first or last page of stream {serial} is misplaced")
        if number != numbers.get(serial, -1) + 1 or bool(kind & CONTINUED) != (serial in parts):
            raise Corrupt(f"page {number} of stream {serial} is out of sequence")
        numbers[serial] = number
        out = streams.setdefault(serial, [])
        packet, done, whole = parts.pop(serial, bytearray()), 0, 0
        open_ = bool(kind & CONTINUED)
        for value in lacing:
            packet += body[done : done + value]
            done += value
            open_ = value == 255
            if not open_:
                out.append((bytes(packet), NO_GRANULE))
                packet, whole = bytearray(), whole + 1
        if open_:
            parts[serial] = packet
        if whole:
            out[-1] = (out[-1][0], granule)
        if kind & LAST:
            ended.add(serial)
    if parts or ended != set(numbers):
        raise Corrupt("a stream does not end")
    return streams


def encode(payload: bytes) -> bytes:
    """payload as 8-bit samples in one logical stream, multiplexed with a stream of notes; equal payloads, equal bytes."""
    serial = zlib.crc32(payload)
    audio, notes = Writer(serial), Writer(serial ^ 0xFFFFFFFF)
    packets = [payload[i : i + PACKET] for i in range(0, len(payload), PACKET)]
    granules = [min(len(payload), i + PACKET) for i in range(0, len(payload), PACKET)]
    out = [*audio.pages([MAGIC_AUDIO + struct.pack("<II", RATE, PACKET)], [0], FIRST)]
    out += notes.pages([MAGIC_NOTES], [0], FIRST)
    turns = range(0, len(packets), 15)
    for i in turns:  # 15 packets of 17 lacing values fill a page; a note of the samples so far follows it
        last = LAST * (i == turns[-1])
        out += audio.pages(packets[i : i + 15], granules[i : i + 15], last)
        out += notes.pages([struct.pack("<q", granules[min(i + 14, len(granules) - 1)])], [granules[min(i + 14, len(granules) - 1)]], last)
    return b"".join(out)


def decode(media: bytes) -> tuple[bytes, int, list[tuple[int, float]]]:
    """Payload, samples a second, and (granule, seconds) of each packet that has a granule position."""
    for packets in demultiplex(media).values():
        if packets and packets[0][0].startswith(MAGIC_AUDIO):
            rate, _ = struct.unpack_from("<II", packets[0][0], len(MAGIC_AUDIO))
            payload = b"".join(p for p, _ in packets[1:])
            times = [(g, g / rate) for _, g in packets[1:] if g != NO_GRANULE]
            if times and times[-1][0] != len(payload):
                raise Corrupt("the last granule position differs from the samples read")
            return payload, rate, times
    raise Corrupt("no audio stream")


def features(payload: bytes, rate: int, times: list[tuple[int, float]], streams: int = 2) -> str:
    """Seconds, mean and root mean square of the samples around 128, zero crossings a sample and pages with a timestamp."""
    x = np.frombuffer(payload, np.uint8).astype(np.int64) - 128
    mean, square = int(x.sum()) / len(x), int((x * x).sum()) / len(x)
    cross = int(np.count_nonzero((x[1:] < 0) != (x[:-1] < 0)))
    return f"rate={rate};seconds={times[-1][1]:.6f};stamps={len(times)};streams={streams};mean={mean:.6f};rms={square**0.5:.6f};crossings={cross / len(x):.6f}"


def padded(text: bytes, block: int = 64) -> bytes:
    """text with bytes 0 appended up to a positive multiple of ``block``."""
    return text.ljust(max(block, -(-len(text) // block) * block), b"\0")


def to_ogg(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text as an Ogg file: (id, n_bytes, media binary).

    A null text is an empty one; no row is dropped. Repeated rows and equal texts give equal files, whatever
    their ids, null ones among them; an empty table gives an empty one. Other columns are not read, so names cannot clash.
    """
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            raw = [(x or "").encode() for x in b.column("text").to_pylist()]
            yield pa.record_batch({"id": b.column("id"), "n_bytes": pa.array([len(x) for x in raw], pa.int64()), "media": pa.array([encode(padded(x)) for x in raw], pa.binary())})

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, media binary").withColumnRenamed("id", id_col)


def read_ogg(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """What the stored bytes hold: payload digest, checksum of the last 64 samples, media digest, features, seconds, status.

    A null or corrupt medium gives null values and its reason in ``status``; a whole one has status ``ok``. Only
    id, n_bytes and media are read; repeated rows are read each on its own, and an empty table gives an empty one.
    """
    made = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, seconds double, status string"

    def one(media: bytes | None):
        if media is None:
            return (None,) * 7 + ("null",)
        shape = (len(media), hashlib.sha256(media).hexdigest())
        try:
            payload, rate, times = decode(media)
        except Corrupt as why:
            return (None, None, None, *shape, None, None, str(why))
        return (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), *shape, features(payload, rate, times), times[-1][1], "ok")

    def run(batches):
        for b in batches:
            got = list(zip(*map(one, b.column("media").to_pylist()), strict=True)) or [()] * 8
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string()]
            names = [x.split()[0] for x in made.split(", ")]
            yield pa.record_batch({"id": b.column("id"), "n_bytes": b.column("n_bytes")} | {n: pa.array(v, k) for n, v, k in zip(names, got, kinds, strict=True)})

    kind = media.schema[id_col].dataType.simpleString()
    rows = media.select(F.col(id_col).alias("id"), "n_bytes", "media")
    return rows.mapInArrow(run, f"id {kind}, n_bytes long, {made}").withColumnRenamed("id", id_col)
