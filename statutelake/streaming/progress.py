"""State and phases of long jobs, read from their progress logs (M4).

Lines are (source, seq, ts, text); ``seq`` numbers a source's lines. What a set
of lines says is kept as small tables that can be folded, so a log may be read at
once or in any number of batches with the same result, as long as a source's
lines come in order (logs are only appended to).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pattern of a line, names of its groups, and the phase that it stands for. Later ones overrule earlier ones.
LOG_RULES: tuple[tuple[str, tuple[str, ...], str | None], ...] = (
    (r"待翻译标题：(\d+) 个", ("title_total",), "titles"),
    (r"待翻译法律：(\d+) 部", ("article_total_laws",), None),
    (r"标题：(\d+)/(\d+)", ("title_done", "title_total"), "titles"),
    (r"待翻译法律：", (), "articles"),
    (r"\[(\d+)/(\d+)\]\s+(.*)（(\d+) 条待翻译", ("article_done", "article_total_laws", "current_law", "current_articles"), "articles"),
    (r"引用 (\d+) 部法律，(\d+) 个术语注入", ("ref_laws", "glossary_terms"), None),
    (r"批次 (\d+)/(\d+) 完成（(\d+)s，(\d+)条）", ("batch_number", "batch_total", "batch_seconds", "batch_articles"), None),
)
COMPLETED = "已写回"
ERROR = r"批次 (\d+)/(\d+) 失败（已重试\d+次）"
RETRY, NO_RETRY = "重试", "批次"
TEXT_FIELDS = ("phase", "current_law", "last_completed")
#: Lines of the end of a log, and characters of the end of an error line.
RECENT, ERROR_CHARS = 20, 80

VALUES = "source string, field string, value string, seq bigint, rule int"


def is_error(text: Column) -> Column:
    retry = F.contains(text, F.lit(RETRY)) & ~F.contains(text, F.lit(NO_RETRY))
    return text.rlike(ERROR) | retry


def _said(text: Column, rules) -> Column:
    """(field, value, rule) of everything that a line says."""
    parts = []
    for i, (pattern, names, phase) in enumerate(rules):
        values = [F.struct(F.lit(n).alias("field"), F.trim(F.regexp_extract(text, pattern, g)).alias("value"), F.lit(i).alias("rule")) for g, n in enumerate(names, 1)]
        if phase is not None:
            values.append(F.struct(F.lit("phase").alias("field"), F.lit(phase).alias("value"), F.lit(i).alias("rule")))
        if values:
            parts.append(F.when(text.rlike(pattern), F.array(*values)).otherwise(F.array()))
    return F.concat(*parts)


def log_values(lines: DataFrame, rules=LOG_RULES) -> DataFrame:
    """The last value of each field of each source, with its place: (source, field, value, seq, rule).

    ``last_completed`` is the field ``current_law`` as it stood at the last line
    that reports a law as written; its value is null if these lines do not say.
    """
    said = lines.select("source", "seq", F.explode(_said(F.col("text"), rules)).alias("s")).select("source", "seq", "s.*")
    last = said.groupBy("source", "field").agg(F.max(F.struct("seq", "rule", "value")).alias("m")).select("source", "field", "m.value", "m.seq", "m.rule")
    done = lines.filter(F.contains("text", F.lit(COMPLETED))).groupBy("source").agg(F.max("seq").alias("done_seq"))
    # A line's own fields are read before it is taken as a report.
    before = said.filter("field = 'current_law'").join(done, "source").filter(F.col("seq") <= F.col("done_seq"))
    law = before.groupBy("source").agg(F.max(F.struct("seq", "rule", "value")).alias("m"))
    completed = done.join(law, "source", "left").select(
        "source", F.lit("last_completed").alias("field"), F.col("m.value").alias("value"), F.col("done_seq").alias("seq"), F.lit(len(rules)).alias("rule")
    )
    return last.unionByName(completed)


def fold_values(deltas: DataFrame) -> DataFrame:
    """Values of several batches as one."""
    last = deltas.groupBy("source", "field").agg(F.max(F.struct("seq", "rule", "value")).alias("m")).select("source", "field", "m.value", "m.seq", "m.rule")
    open_ = last.filter("field = 'last_completed' AND value IS NULL").select("source", F.col("seq").alias("done_seq"))
    laws = deltas.filter("field = 'current_law'").join(open_, "source").filter(F.col("seq") < F.col("done_seq"))
    filled = laws.groupBy("source").agg(F.max(F.struct("seq", "rule", "value")).alias("m")).select("source", F.lit("last_completed").alias("field"), F.col("m.value").alias("known"))
    return last.join(filled, ["source", "field"], "left").select("source", "field", F.coalesce("value", "known").alias("value"), "seq", "rule")


def log_counts(lines: DataFrame) -> DataFrame:
    """(source, lines, errors, last_seq) of a set of lines."""
    return lines.groupBy("source").agg(F.count("*").alias("lines"), F.count_if(is_error(F.col("text"))).alias("errors"), F.max("seq").alias("last_seq"))


def fold_counts(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("source").agg(F.sum("lines").alias("lines"), F.sum("errors").alias("errors"), F.max("last_seq").alias("last_seq"))


def progress_state(values: DataFrame, counts: DataFrame, rules=LOG_RULES) -> DataFrame:
    """One row per source with all fields as columns.

    ``article_pending_laws`` is what is left of the laws if both numbers are
    known and not 0. ``last_completed`` is empty if a law was written before any
    was named, and null if none was written.
    """
    names = list(dict.fromkeys(["phase", *[n for _, group, _ in rules for n in group], "last_completed"]))
    wide = values.groupBy("source").agg(
        *[F.max(F.when(F.col("field") == n, F.coalesce("value", F.lit("")))).alias(n) for n in names]
    )
    wide = counts.join(wide, "source", "left")
    typed = [F.col(n) if n in TEXT_FIELDS else F.col(n).try_cast("bigint").alias(n) for n in names]
    out = wide.select("source", "lines", "errors", "last_seq", *typed)
    total, done = F.nullif("article_total_laws", F.lit(0)), F.nullif("article_done", F.lit(0))
    batch = F.when(F.col("batch_number").isNotNull(), F.concat_ws("/", "batch_number", "batch_total"))
    return out.withColumn("article_pending_laws", total - done).withColumn("current_batch", batch).drop("batch_number", "batch_total")


def log_state(lines: DataFrame, rules=LOG_RULES) -> DataFrame:
    """M4: the state of every source, from all its lines at once."""
    return progress_state(fold_values(log_values(lines, rules)), log_counts(lines), rules)


def log_errors(lines: DataFrame, chars: int = ERROR_CHARS) -> DataFrame:
    """M4: the end of each line that reports an error or a retry; rows, as there may be many."""
    return lines.filter(is_error(F.col("text"))).select("source", "seq", F.substring("text", -chars, chars).alias("error"))


def recent_lines(lines: DataFrame, k: int = RECENT) -> DataFrame:
    """M4: the last ``k`` lines of each source, the latest first."""
    order = Window.partitionBy("source").orderBy(F.desc("seq"))
    return lines.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k).select("source", "place", "seq", "text")


# Phases as runs of lines: gaps and islands that join at the borders of pieces.

RUNS = "source string, phase string, start bigint, `end` bigint, start_ts timestamp, end_ts timestamp, n bigint"


def _aggregated(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that are runs already (a mark is a run of one line) as one run per key."""
    return rows.groupBy(*keys).agg(
        F.first("phase").alias("phase"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.min_by("start_ts", "start").alias("start_ts"), F.max_by("end_ts", "end").alias("end_ts"), F.sum("n").alias("n"),
    )


def fold_runs(runs: DataFrame, piece: str) -> DataFrame:
    """Runs of phases of the pieces of a log as those of the whole log.

    Only the first and the last run of a piece can go on in another piece, so
    these are put in order by source, two rows for each piece at most; all runs
    between them are final as they are. Pieces of a source do not overlap.
    """
    ends = runs.groupBy("source", piece).agg(F.min("start").alias("lo"), F.max("start").alias("hi"))
    marked = runs.join(ends, ["source", piece]).withColumn("border", F.col("start").isin(F.col("lo"), F.col("hi"))).drop("lo", "hi")
    inner = marked.filter(~F.col("border")).drop("border", piece)
    order = Window.partitionBy("source").orderBy("start")
    joined = (F.lag("phase").over(order) == F.col("phase")) & (F.lag(piece).over(order) != F.col(piece))
    border = marked.filter("border").withColumn("new", F.when(joined, 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    whole = _aggregated(border, ["source", "run"]).drop("run")
    return whole.unionByName(inner.select(*whole.columns))


def phase_runs(lines: DataFrame, span: int = 100_000, rules=LOG_RULES) -> DataFrame:
    """M4: every phase of every source as (source, phase, start, end, start_ts, end_ts, n).

    A phase lasts from the first to the last of the lines that name it with none
    naming another one between; ``n`` counts them. A log is cut into pieces of
    ``span`` line numbers, so a source with most of the lines is many tasks.
    """
    named = [(i, p) for i, (_, _, p) in enumerate(rules) if p is not None]
    phase = F.coalesce(*[F.when(F.col("text").rlike(rules[i][0]), p) for i, p in reversed(named)])
    marks = lines.select(
        "source", phase.alias("phase"), F.col("seq").alias("start"), F.col("seq").alias("end"), F.col("ts").alias("start_ts"),
        F.col("ts").alias("end_ts"), F.lit(1).cast("bigint").alias("n"), F.expr(f"seq div {span}").alias("piece"),
    ).filter("phase IS NOT NULL")
    order = Window.partitionBy("source", "piece").orderBy("start")
    cut = marks.withColumn("new", F.when(F.lag("phase").over(order) == F.col("phase"), 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    return fold_runs(_aggregated(cut, ["source", "piece", "run"]).drop("run"), "piece").select("source", "phase", "start", "end", "start_ts", "end_ts", "n")
