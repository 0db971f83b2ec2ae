"""Quality rules: count rules, then robust multivariate outliers, DataFrame functions only.

Each text gives five transformed statistics. For every (language, source) group the minimum covariance
determinant estimate is found by concentration steps: start at medians and absolute deviations, take the
``CORE`` share of rows that lie nearest, set centre and scatter to theirs, and repeat until the determinant
settles. A row goes if its squared Mahalanobis distance (scaled so that the group's median distance is
that of a normal distribution) exceeds ``CUTOFF``.

Everything per group is an aggregate with partial sums, so a group with a third of all rows is reduced
in many tasks. Groups under ``LEAST_ROWS`` rows share one pooled estimate. Every statistic has a least
spread (``FLOORS``): where nearly all texts have none of something, a trace of it is no outlier. Each floor
is small enough that the statistic's range alone exceeds the cutoff.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseload.llm.common import SPACES, stash, text_or_empty

SYMBOLS = "#*$%&|<>"  # fixed value of the contract
LEAST_WORDS = 50
FEATURES = ("f_length", "f_word", "f_symbols", "f_dup_lines", "f_repeats")
FLOORS = (0.5, 0.15, 0.3, 1.0, 0.85)
CORE = 0.75
LEAST_ROWS = 200
STEPS = 8
SETTLED = 1e-3  # relative change of every determinant
CHI2_MEDIAN = 4.351  # of five squared standard normals
CUTOFF = 20.515  # 0.999 quantile of the same sum


def text_counts(text: Column) -> dict[str, Column]:
    """Columns that need no words of the text."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    return {
        "words": F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " ", -1), ""),
        "word_chars": F.length(F.translate(text, SPACES, "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "lines": lines,
    }


def repeated_words(grams: Column) -> Column:
    """Words covered by 3-word windows whose hash occurs twice: ``grams`` holds a hash for each window."""
    last = F.size("sorted") - 1
    equal = lambda a, b: F.coalesce(F.get("sorted", a)["gram"] == F.get("sorted", b)["gram"], F.lit(False))
    hits = F.filter(F.sequence(F.lit(0), last), lambda k: equal(k, k - 1) | equal(k, k + 1))
    at = F.transform(hits, lambda k: F.get("sorted", k)["at"])
    return F.when(last >= 0, F.size(F.array_distinct(F.flatten(F.transform(at, lambda i: F.array(i, i + 1, i + 2)))))).otherwise(0)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """id, group columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of every whole text."""
    raw = docs.select(F.col(f"`{id_col}`").alias(id_col), *[F.col(f"`{c}`").cast("string").alias(f"g{i}") for i, c in enumerate(group_cols)],
                      text_or_empty(F.col(f"`{text_col}`")).alias("text"))
    keys = [id_col, *[f"g{i}" for i in range(len(group_cols))]]
    counted = raw.select(*keys, *[c.alias(n) for n, c in text_counts(F.col("text")).items()])
    n = F.size("words")
    empty = F.array().cast("array<bigint>")
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get("words", i), F.get("words", i + 1), F.get("words", i + 2)))).otherwise(empty)
    windows = counted.select(
        *keys, n.cast("long").alias("n_words"), "word_chars", "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"), F.size("lines").alias("n_lines"), grams.alias("grams"))
    pairs = F.transform("grams", lambda g, i: F.struct(g.alias("gram"), i.alias("at")))
    doubled = F.size(F.array_distinct("grams")) < F.size("grams")
    found = windows.select("*", F.when(doubled, F.sort_array(pairs)).otherwise(F.array().cast("array<struct<gram:bigint,at:int>>")).alias("sorted"))
    out = found.select(*keys, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", repeated_words(F.col("grams")).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def transformed() -> dict[str, Column]:
    """The statistic vector: logarithms, and logarithms of percentages."""
    share = lambda a, b: F.log1p(100.0 * F.col(a) / F.greatest(F.col(b), F.lit(1)))
    return dict(zip(FEATURES, (
        F.log1p(F.col("n_words").cast("double")), F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
        share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words"))))


def _inverse(moments: DataFrame) -> DataFrame:
    """Centre, precision matrix and determinant from the moments m_i, c_ij of each group, by Cholesky factors."""
    p = len(FEATURES)
    out = moments
    for j in range(p):  # lower factor, one column of it at a time
        done = lambda i, j=j: sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - done(j), F.lit(1e-12))))
        out = out.withColumns({f"l{i}{j}": (F.col(f"c{i}{j}") - done(i)) / F.col(f"l{j}{j}") for i in range(j + 1, p)})
    for j in range(p):  # its inverse
        out = out.withColumn(f"v{j}{j}", 1.0 / F.col(f"l{j}{j}"))
        for i in range(j + 1, p):
            out = out.withColumn(f"v{i}{j}", -sum((F.col(f"l{i}{k}") * F.col(f"v{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"l{i}{i}"))
    precision = {f"p{i}{j}": sum((F.col(f"v{k}{i}") * F.col(f"v{k}{j}") for k in range(i, p)), F.lit(0.0)) for i in range(p) for j in range(i + 1)}
    log_det = 2 * sum((F.log(F.col(f"l{j}{j}")) for j in range(p)), F.lit(0.0))
    return out.select("grp", *[f"m{i}" for i in range(p)], *[c.alias(n) for n, c in precision.items()], log_det.alias("log_det"))


def _distance() -> Column:
    p = len(FEATURES)
    z = [F.col(f) - F.col(f"m{i}") for i, f in enumerate(FEATURES)]
    return sum((F.col(f"p{i}{j}") * z[i] * z[j] * (1.0 if i == j else 2.0) for i in range(p) for j in range(i + 1)), F.lit(0.0))


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and floored covariance of each group's rows; the features are centred on the first medians before."""
    p = len(FEATURES)
    shifted = [F.col(f) - F.col(f"o{i}") for i, f in enumerate(FEATURES)]
    sums = [F.avg(z).alias(f"a{i}") for i, z in enumerate(shifted)]
    sums += [F.avg(shifted[i] * shifted[j]).alias(f"s{i}{j}") for i in range(p) for j in range(i + 1)]
    got = rows.groupBy("grp").agg(*sums, *[F.first(f"o{i}").alias(f"o{i}") for i in range(p)])
    return got.select("grp", *[(F.col(f"a{i}") + F.col(f"o{i}")).alias(f"m{i}") for i in range(p)], *[
        (F.col(f"s{i}{j}") - F.col(f"a{i}") * F.col(f"a{j}") + (FLOORS[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}")
        for i in range(p) for j in range(i + 1)])


def mcd(rows: DataFrame) -> DataFrame:
    """Per group of ``rows`` (grp, features): centre, precision, log determinant, and ``scale`` of the distances."""
    p = len(FEATURES)
    middle = stash(rows.groupBy("grp").agg(*[F.percentile_approx(f, 0.5).alias(f"o{i}") for i, f in enumerate(FEATURES)]), "quality-medians")
    rows = rows.join(middle, "grp")
    spread = rows.groupBy("grp").agg(*[F.percentile_approx(F.abs(F.col(f) - F.col(f"o{i}")), 0.5).alias(f"d{i}") for i, f in enumerate(FEATURES)])
    start = middle.join(spread, "grp").select("grp", *[F.col(f"o{i}").alias(f"m{i}") for i in range(p)], *[
        ((1.4826 * F.col(f"d{i}")) ** 2 + FLOORS[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in range(p) for j in range(i + 1)])
    now = stash(_inverse(start), "quality-mcd")
    for step in range(STEPS):
        far = rows.join(now, "grp").select("grp", *FEATURES, *[f"o{i}" for i in range(p)], _distance().alias("d2"))
        edge = far.groupBy("grp").agg(F.percentile_approx("d2", CORE).alias("edge"))
        core = far.join(edge, "grp").where(F.col("d2") <= F.col("edge"))
        new = stash(_inverse(_moments(core)), "quality-mcd")
        moved = new.join(now.select("grp", F.col("log_det").alias("was")), "grp").agg(F.max(F.abs(F.col("log_det") - F.col("was")))).first()[0]
        now = new
        if step and (moved is None or moved < SETTLED):
            break
    median = rows.join(now, "grp").groupBy("grp").agg(F.percentile_approx(_distance(), 0.5).alias("half"))
    return stash(now.join(median.select("grp", F.greatest(F.col("half") / CHI2_MEDIAN, F.lit(1.0)).alias("scale")), "grp"), "quality-mcd")


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_cols: tuple[str, ...] = ("lang", "source"),
            cutoff: float = CUTOFF) -> DataFrame:
    """Statistics, base_failed, distance and kept of every row of ``docs``.

    Null texts have no words; null languages and sources are groups of their own; rows repeat if they
    repeat in ``docs``; an empty table gives no rows; other columns are ignored. Rows that fail the
    count rules take no part in the estimates and have no distance. If fewer than ``LEAST_ROWS`` rows
    are left for the pooled estimate, its rows are kept."""
    groups = [f"g{i}" for i in range(len(group_cols))]
    # null-safe group name: a null is told from every string
    name = F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("="), F.col(g)), F.lit("-")) for g in groups])
    rows = stash(statistics(docs, id_col, text_col, group_cols).select("*", *[c.alias(n) for n, c in transformed().items()], name.alias("own")), "quality-stats")
    sizes = rows.where(~F.col("base_failed")).groupBy("own").agg(F.count("*").alias("n")).withColumn(
        "grp", F.when(F.col("n") >= LEAST_ROWS, F.col("own")).otherwise("*"))
    sizes = stash(sizes, "quality-groups")
    named = rows.join(sizes.select("own", "grp"), "own", "left")
    fit = named.where(~F.col("base_failed")).select("grp", *FEATURES)
    enough = sizes.groupBy("grp").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_ROWS).select("grp")
    estimates = mcd(fit.join(enough, "grp", "left_semi"))
    out = named.join(estimates, "grp", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance() / F.col("scale")))
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= cutoff)
    return out.select(id_col, *[F.col(g).alias(c) for g, c in zip(groups, group_cols)], "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))
