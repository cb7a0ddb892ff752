"""Question-answer pairs: from tests_* edges, from exercises, merged parts, and the training mix."""

from __future__ import annotations

import hashlib
import random

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import measures as M
from lectern.functions import text
from lectern.operators.fixpoint import ranked

# Fixed values of the data format.
RATIOS = {"is_a": 0.60, "verifies": 0.60, "prerequisites_for": 0.35, "relates_to": 0.35}
SEED = 20260412
PARTS = ("concept", "skill", "is_a", "prerequisites_for", "relates_to", "verifies", "tests_concept", "tests_skill", "exercise")


def tests_pairs(edges: DataFrame, separator: str = "，") -> DataFrame:
    """(source, answer, n) of tests_* edges (source, target_name, ord): names in first-seen order, each once."""
    once = edges.where(F.btrim("target_name") != "").groupBy("source", "target_name").agg(F.min("ord").alias("ord"))
    rows = F.array_sort(F.collect_list(F.struct("ord", "target_name")))
    names = F.transform(rows, lambda r: r.target_name)
    return once.groupBy("source").agg(F.array_join(names, separator).alias("answer"), F.count("*").alias("n"))


def exercise_records(items: DataFrame, mode: str = "hybrid", min_score: int = 3, reasoning_format: str = "both") -> DataFrame:
    """Training records of exercises (id, subject, stem, answer, analysis, type), in one of five modes.

    answer, analysis: rows that may be asked so. reasoning: both, with a score of ``min_score`` or more.
    hybrid: one of the two. dual: either and both as two rows.
    """
    stem, answer, kind = text.exercise_text(F.col("stem")), text.exercise_text(F.col("answer")), text.exercise_text(F.col("type"))
    rows = items.select("id", "subject", stem.alias("stem"), answer.alias("answer"), text.analysis_text(F.col("analysis")).alias("analysis"), kind.alias("question_type")).where("stem <> ''")
    a_ok, b_ok = M.emits_answer(F.col("question_type"), F.col("answer")), M.emits_analysis(F.col("analysis"))
    head = F.concat(F.lit("题目："), F.col("stem"), F.lit("\n\n"))
    direct = F.concat(head, F.lit("请直接给出答案。"))
    short, long = F.col("question_type").isin(*M.SHORT_ANSWER), F.col("question_type").isin(*M.REASONING)
    reason = F.concat(head, F.when(long, "请简要说明证明思路或关键推理。").when(short, "请简要说明解题步骤和关键计算。").otherwise("请简要说明作答依据或分析思路。"))
    think = F.concat(head, F.when(F.col("question_type") == M.PROOF, "请先给出关键推理，再给出结论，尽量写得清楚简洁。").when(short, "请写出关键分析过程，并给出最终答案。").otherwise("请给出简要分析过程，并明确写出最终答案。"))

    def record(name: str | Column, question: Column, target: Column) -> Column:
        name = F.lit(name) if isinstance(name, str) else name
        return F.struct(F.concat(F.lit("exercise_"), name).alias("task"), name.alias("source_mode"), question.alias("question"), target.alias("target"))

    by_answer, by_analysis = record("answer", direct, F.col("answer")), record("analysis", reason, F.col("analysis"))
    if mode == "reasoning":
        score = M.analysis_score(F.col("answer"), F.col("analysis"))
        whole = F.col("analysis") if reasoning_format == "analysis_only" else F.concat(F.col("analysis"), F.lit("\n\n答案："), F.col("answer"))
        rows = rows.where(b_ok & (F.col("answer") != "") & (score >= min_score))
        made = F.array(record("reasoning", think, whole))
    elif mode in ("answer", "analysis"):
        rows = rows.where(a_ok if mode == "answer" else b_ok)
        made = F.array(by_answer if mode == "answer" else by_analysis)
    elif mode == "hybrid":
        pick = M.hybrid_mode(F.col("question_type"), a_ok, b_ok)
        made = F.when(pick == "answer", F.array(by_answer)).when(pick == "analysis", F.array(by_analysis))
    elif mode == "dual":
        made = F.array_compact(F.array(F.when(a_ok, by_answer), F.when(b_ok, by_analysis)))
    else:
        raise ValueError(f"unknown mode {mode}")
    return rows.select(F.col("id").alias("source_id"), "subject", "question_type", "stem", F.explode(made).alias("r")).select("r.task", "source_id", "r.source_mode", "subject", "question_type", "stem", "r.question", F.col("r.target").alias("answer"))


def merged_parts(parts: dict[str, DataFrame], kind: str) -> DataFrame:
    """Parts (ord, question, answer, ...) in the fixed order, numbered {kind}_item_1 and on."""
    out = None
    for name, rows in parts.items():
        rows = rows.withColumn("part_no", F.lit(PARTS.index(name)))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return numbered(out, kind)


def numbered(rows: DataFrame, kind: str) -> DataFrame:
    """id {kind}_item_n by (part_no, ord), through ranges of that order."""
    return ranked(rows, "part_no", "ord", name="_n").withColumn("id", F.concat(F.lit(f"{kind}_item_"), F.col("_n").cast("string"))).drop("_n", "part_no")


def wanted(task: Column, total: Column, ratios: dict[str, float] = RATIOS) -> Column:
    """Rows to keep of a task: its share, rounded half to even, at least 1; all rows of tasks without one."""
    share = F.try_element_at(F.create_map(*[F.lit(v) for kv in ratios.items() for v in kv]), task)
    return F.when(share.isNull() | (total == 0), total).otherwise(F.greatest(F.lit(1), F.bround(total * share).cast("long")))


def records(rows: DataFrame) -> DataFrame:
    """Rows with stripped question and answer; blank ones go."""
    made = rows.withColumns({c: text.stripped(text.unix_lines(F.coalesce(c, F.lit("")))) for c in ("question", "answer")})
    return made.where("question <> '' AND answer <> ''")


def deduped(rows: DataFrame, mode: str = "question_answer") -> DataFrame:
    """The first row by ord of each (question, answer), or question, or all rows."""
    if mode == "none":
        return rows
    keys = ["question", "answer"] if mode == "question_answer" else ["question"]
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy("ord"))).where("_n = 1").drop("_n")


def sampled(rows: DataFrame, key_col: str = "task", seed: int = SEED, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """The wanted number of rows of each task, those with the least hash of (seed, task, ord).

    Rows fall into 4,096 buckets of hashes a task. Buckets below the border are taken whole, and rows are
    ranked in the border's bucket alone, so that no task sorts all rows of a task.
    """
    hashed = rows.withColumn("_h", F.md5(F.concat_ws(":", F.lit(seed), F.col(key_col), F.col("ord")))).withColumn("_b", F.substring("_h", 1, 3))
    sizes = hashed.groupBy(key_col, "_b").agg(F.count("*").alias("_c"))
    whole = Window.partitionBy(key_col)
    until = F.sum("_c").over(whole.orderBy("_b"))
    sizes = sizes.withColumns({"_most": wanted(F.col(key_col), F.sum("_c").over(whole), ratios), "_until": until})
    room = sizes.where("_until - _c < _most").select(F.col(key_col), "_b", F.when(F.col("_until") > F.col("_most"), F.col("_most") - F.col("_until") + F.col("_c")).alias("_room"))
    near = hashed.join(room, [key_col, "_b"])
    border = near.where("_room IS NOT NULL").withColumn("_n", F.row_number().over(Window.partitionBy(key_col, "_b").orderBy("_h", "ord"))).where("_n <= _room").drop("_n")
    return near.where("_room IS NULL").unionByName(border).drop("_h", "_b", "_room")


def replayed_sample(rows: DataFrame, file_col: str = "file", key_col: str = "task", seed: int = SEED, ratios: dict[str, float] = RATIOS) -> DataFrame:
    """The wanted share of each file of a task, drawn by Python's seeded shuffle of the file's rows.

    An exact replay for part files, which are small: only the rows' order columns of a file travel to
    one task. sampled() is the way for data of any size.
    """
    keys = rows.select(file_col, key_col, "ord")

    def draw(frame: pd.DataFrame) -> pd.DataFrame:
        name, task, total = str(frame[file_col].iloc[0]), str(frame[key_col].iloc[0]), len(frame)
        count = max(1, round(total * ratios[task])) if task in ratios else total
        frame = frame.sort_values("ord")
        if count >= total:
            return frame
        order = list(range(total))
        random.Random(seed + int(hashlib.md5(name.encode()).hexdigest()[:8], 16)).shuffle(order)
        return frame.iloc[order[:count]]

    return rows.join(keys.groupBy(file_col).applyInPandas(draw, keys.schema), [file_col, key_col, "ord"], "left_semi")
