"""Quality rules whose thresholds come from quantile sketches per language and source.

The sketch of a metric is a histogram of integers with a relative width of 1/32: values below 64
have a bucket each, larger ones share it with those that have the same first six bits. Sketches of
two sets of rows are merged by adding their counts, so a hot source is summed within each map task.
The fences of a source lean towards those of its language, and these towards those of everything,
the more the fewer documents there are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm import common

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"
_SALTS = 32


@dataclass(frozen=True)
class Metric:
    """An integer expression and how far from the middle of its group a document may lie.

    The upper fence is `reach` interquartile ranges above the upper quartile, or the quantile of
    `tail` in 1,000 where that is higher, as it is where most values are equal; the lower fence is
    its mirror image. Both are edges of the sketch's buckets.
    """

    name: str
    sql: str
    tail: int
    reach: int = 3
    low_side: bool = False


#: Shares are in units of 1/10,000, the word length in 1/100 characters.
METRICS = (
    Metric("symbols", "n_symbols * 10000 div greatest(word_chars, 1)", tail=950),
    Metric("dup_lines", "n_dup_lines * 10000 div greatest(n_lines, 1)", tail=990),
    Metric("repeats", "n_repeat_words * 10000 div greatest(n_words, 1)", tail=990),
    Metric("word_length", "word_chars * 100 div greatest(n_words, 1)", tail=950, low_side=True),
)


def signals(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the base counts of each whole text to the columns there are.

    Repeated windows are found inside the row: the hashes of its windows are compared as a set
    first, and only a text with a repeat sorts them.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    with_words = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    parts = docs.withColumns({"_words": common.words(text), "_lines": with_words})
    parts = parts.withColumn("_n", F.size("_words"))

    def window_hash(i: Column) -> Column:
        return F.xxhash64(*(F.get("_words", i + k) for k in range(WINDOW)))

    starts = F.sequence(F.lit(0), F.col("_n") - WINDOW)
    hashes = F.when(F.col("_n") >= WINDOW, F.transform(starts, window_hash))
    hashed = parts.withColumn("_hashes", hashes)
    repeated = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    placed = F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    ordered = hashed.withColumn("_placed", F.when(repeated, F.sort_array(placed)))

    def has_equal_neighbour(entry: Column, k: Column) -> Column:
        return (entry["h"] == F.get("_placed", k - 1)["h"]).eqNullSafe(True) | (
            entry["h"] == F.get("_placed", k + 1)["h"]
        ).eqNullSafe(True)

    positions = F.array_sort(
        F.transform(F.filter("_placed", has_equal_neighbour), lambda entry: entry["i"])
    )
    found = ordered.withColumn("_at", positions)
    gaps = F.transform(
        "_at", lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_at", k + 1) - at, F.lit(WINDOW)))
    )
    covered = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    counted = found.withColumns(
        {
            "n_words": F.col("_n").cast("long"),
            "word_chars": F.length(F.regexp_replace(text, common.SPACE_RUN, "")).cast("long"),
            "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
        }
    )
    return counted.drop("_words", "_lines", "_n", "_hashes", "_placed", "_at")


def _group_key(column: str) -> Column:
    """Null is a group of its own, apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(column)), F.lit("-"))


def sketch(features: DataFrame, metrics: tuple[Metric, ...] = METRICS) -> DataFrame:
    """Counts per (lang_key, source_key, metric, low): mergeable by adding n."""
    values = F.explode(
        F.array(
            *(
                F.struct(F.lit(m.name).alias("metric"), F.expr(m.sql).alias("value"))
                for m in metrics
            )
        )
    )
    width = F.expr(
        "if(m.value < 64, 1L, shiftleft(1L, cast(length(bin(m.value)) - 6 as int)))"
    )
    return (
        features.filter(~F.col("base_failed"))
        .select("lang_key", "source_key", values.alias("m"))
        .select("lang_key", "source_key", "m.metric", "m.value", width.alias("width"))
        .groupBy(
            "lang_key",
            "source_key",
            "metric",
            (F.col("value") - F.col("value") % F.col("width")).alias("low"),
            "width",
        )
        .agg(F.count("*").alias("n"))
    )


def thresholds(
    sketches: DataFrame, min_group: int = 200, metrics: tuple[Metric, ...] = METRICS
) -> DataFrame:
    """Fences per (lang_key, source_key) that occurs: <metric>_low and <metric>_high.

    The fence of a language with n documents is the mean of its own, which counts n times, and that
    of all documents, which counts min_group times; that of a group is the mean of its own and that
    of its language in the same way.
    """
    keys = ["lang_key", "source_key", "metric", "low", "width"]
    levels = [
        sketches.withColumn("level", F.lit(0)),
        sketches.withColumns({"level": F.lit(1), "source_key": F.lit("*")}),
        sketches.withColumns({"level": F.lit(2), "source_key": F.lit("*"), "lang_key": F.lit("*")}),
    ]
    merged = levels[0].unionByName(levels[1]).unionByName(levels[2])
    merged = merged.groupBy("level", *keys).agg(F.sum("n").alias("n"))
    group = Window.partitionBy("level", "lang_key", "source_key", "metric")
    running = merged.withColumns(
        {"total": F.sum("n").over(group), "upto": F.sum("n").over(group.orderBy("low"))}
    )
    rules = F.col("metric")
    tail = F.coalesce(*(F.when(rules == m.name, F.lit(m.tail)) for m in metrics))
    reach = F.coalesce(*(F.when(rules == m.name, F.lit(m.reach)) for m in metrics))

    def first(share: Column | int, edge: Column) -> Column:
        """The edge of the first bucket up to which `share` in 1,000 documents lie."""
        return F.min(F.when(1000 * F.col("upto") >= share * F.col("total"), edge))

    lower, upper = F.col("low"), F.col("low") + F.col("width") - 1
    # One row per bucket, so at most some 2,000 a group.
    quantiles = running.groupBy("level", "lang_key", "source_key", "metric", "total").agg(
        first(250, lower).alias("q1"),
        first(750, upper).alias("q3"),
        first(1000 - tail, lower).alias("bottom"),
        first(tail, upper).alias("top"),
    )
    margin = reach * (F.col("q3") - F.col("q1"))
    fenced = quantiles.withColumns(
        {
            "lowest": F.greatest(F.least(F.col("q1") - margin, "bottom"), F.lit(0)),
            "highest": F.greatest(F.col("q3") + margin, "top"),
        }
    )
    wide = fenced.groupBy("level", "lang_key", "source_key", "total").agg(
        *(
            F.max(F.when(rules == m.name, F.col(side))).alias(f"{m.name}_{end}")
            for m in metrics
            for side, end in (("lowest", "low"), ("highest", "high"))
        )
    )
    names = [f"{m.name}_{end}" for m in metrics for end in ("low", "high")]
    by_level = [
        wide.filter(F.col("level") == k).select(
            F.col("lang_key").alias("lang_key"),
            F.col("source_key").alias("source_key"),
            F.col("total").alias(f"total{k}"),
            *(F.col(name).alias(f"{name}{k}") for name in names),
        )
        for k in range(3)
    ]
    every = F.lit("*") == F.col("all")
    joined = (
        by_level[0]
        .join(by_level[1].drop("source_key"), "lang_key")
        .join(by_level[2].withColumn("all", F.lit("*")).drop("lang_key", "source_key"), every)
    )

    def towards(own: str, total: str, wider: str) -> str:
        return f"(({own}) * {total} + ({wider}) * {min_group}L) div ({total} + {min_group}L)"

    fences = (
        F.expr(towards(f"{n}0", "total0", towards(f"{n}1", "total1", f"{n}2"))).alias(n)
        for n in names
    )
    return joined.select("lang_key", "source_key", *fences)


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    min_group: int = 200,
    metrics: tuple[Metric, ...] = METRICS,
) -> DataFrame:
    """Base counts and verdict of every row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, base_failed, kept.

    A null text has no words and fails the base rules. A null language or source is a group of
    its own. Rows with the same doc_id are judged each for itself; other columns of the input are not
    read. A text of any length is judged whole; its words are one row's array. Every document that
    passes the base rules counts in the sketches, and one that lies
    outside a fence of its group is not kept. An empty table gives no rows.
    """
    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(text_col).alias("text"),
        _group_key(lang_col).alias("lang_key"),
        _group_key(source_col).alias("source_key"),
    )
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    features = signals(narrow).drop("text").withColumn("base_failed", base_failed)
    # Texts are read once; what follows works on a few numbers per document.
    features = common.stored(features, "quality-signals")
    salt = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
    fences = thresholds(sketch(features, metrics), min_group, metrics).withColumn("salt", salt)
    salted = features.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int"))
    joined = salted.join(fences, ["lang_key", "source_key", "salt"], "left")
    inside = F.lit(True)
    for m in metrics:
        value = F.expr(m.sql)
        inside = inside & (value <= F.col(f"{m.name}_high"))
        if m.low_side:
            inside = inside & (value >= F.col(f"{m.name}_low"))
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        "n_lines",
    )


def oracle_sql(min_group: int = 200, metrics: tuple[Metric, ...] = METRICS) -> str:
    """The whole operator in DuckDB, for tables whose doc_id is unique."""
    values = " UNION ALL ".join(
        f"SELECT doc_id, lang_key, source_key, '{m.name}' AS metric, "
        f"({m.sql.replace(' div ', ' // ')})::BIGINT AS value, "
        f"{m.tail} AS tail, {m.reach} AS reach, {m.low_side} AS low_side, base_failed FROM base"
        for m in metrics
    )
    return f"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text, coalesce('=' || lang, '-') AS lang_key,
            coalesce('=' || source, '-') AS source_key FROM documents),
    parts AS (
        SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws,
            list_filter(string_split(text, chr(10)),
                lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines
        FROM texts),
    windows AS (
        SELECT doc_id, i, ws[i:i + {WINDOW - 1}] AS g
        FROM parts, unnest(range(1, len(ws) - {WINDOW - 2})) AS t(i)),
    twice AS (
        SELECT doc_id, i FROM windows
        QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
    gaps AS (
        SELECT doc_id, least({WINDOW}, coalesce(
            lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, {WINDOW})) AS gap FROM twice),
    covered AS (SELECT doc_id, sum(gap)::BIGINT AS n FROM gaps GROUP BY doc_id),
    counted AS (
        SELECT doc_id, lang_key, source_key, len(ws)::BIGINT AS n_words,
            length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
            len(regexp_extract_all(text, '{SYMBOLS}'))::BIGINT AS n_symbols,
            len(lines)::BIGINT AS n_lines,
            (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
            coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM parts LEFT JOIN covered USING (doc_id)),
    base AS (
        SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
        FROM counted),
    measured AS (
        SELECT *, CASE WHEN value < 64 THEN 1
            ELSE 1::BIGINT << (length(bin(value)) - 6)::BIGINT END AS width
        FROM ({values})),
    buckets AS (
        SELECT *, value - value % width AS low FROM measured WHERE NOT base_failed),
    levels AS (
        SELECT 0 AS level, lang_key, source_key, metric, tail, reach, low, width FROM buckets
        UNION ALL
        SELECT 1, lang_key, '*', metric, tail, reach, low, width FROM buckets
        UNION ALL
        SELECT 2, '*', '*', metric, tail, reach, low, width FROM buckets),
    merged AS (
        SELECT level, lang_key, source_key, metric, tail, reach, low, width, count(*) AS n
        FROM levels GROUP BY ALL),
    running AS (
        SELECT *, (sum(n) OVER g)::BIGINT AS total,
            (sum(n) OVER (g ORDER BY low))::BIGINT AS upto FROM merged
        WINDOW g AS (PARTITION BY level, lang_key, source_key, metric)),
    quantiles AS (
        SELECT level, lang_key, source_key, metric, reach, total,
            min(low) FILTER (1000 * upto >= 250 * total) AS q1,
            min(low + width - 1) FILTER (1000 * upto >= 750 * total) AS q3,
            min(low) FILTER (1000 * upto >= (1000 - tail) * total) AS bottom,
            min(low + width - 1) FILTER (1000 * upto >= tail * total) AS top
        FROM running GROUP BY ALL),
    fences AS (
        SELECT *, greatest(least(q1 - reach * (q3 - q1), bottom), 0)::BIGINT AS lowest,
            greatest(q3 + reach * (q3 - q1), top)::BIGINT AS highest FROM quantiles),
    by_language AS (
        SELECT l.lang_key, l.metric,
            (l.lowest * l.total + e.lowest * {min_group}) // (l.total + {min_group}) AS lowest,
            (l.highest * l.total + e.highest * {min_group}) // (l.total + {min_group}) AS highest
        FROM fences AS l JOIN fences AS e ON e.level = 2 AND e.metric = l.metric
        WHERE l.level = 1),
    by_group AS (
        SELECT g.lang_key, g.source_key, g.metric,
            (g.lowest * g.total + l.lowest * {min_group}) // (g.total + {min_group}) AS lowest,
            (g.highest * g.total + l.highest * {min_group}) // (g.total + {min_group}) AS highest
        FROM fences AS g JOIN by_language AS l ON l.lang_key = g.lang_key AND l.metric = g.metric
        WHERE g.level = 0),
    verdicts AS (
        SELECT m.doc_id, bool_and(m.value <= f.highest
            AND (NOT m.low_side OR m.value >= f.lowest)) AS inside
        FROM measured AS m JOIN by_group AS f ON f.metric = m.metric
            AND f.lang_key = m.lang_key AND f.source_key = m.source_key
        GROUP BY m.doc_id)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed AND coalesce(inside, false) AS kept, n_lines
    FROM base LEFT JOIN verdicts USING (doc_id)
    """
