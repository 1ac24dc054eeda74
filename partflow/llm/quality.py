"""Quality rules with robust multivariate outliers. DataFrame functions only.

Each text gives a vector of transformed statistics. Per language and source the minimum
covariance determinant is estimated: from two robust starts, concentration steps keep the
three quarters of the rows nearest in Mahalanobis distance and re-estimate mean and
covariance from them; the start with the smaller determinant wins, its distances are scaled
to the chi-square median, and one reweighting step re-estimates from all rows that are not
far out. Rows beyond the cut are rejected.

Every step is a grouped aggregate of counts, sums and cross products, combined before the
shuffle, so a hot source is one small state per task. The Cholesky factors and distances are
column expressions. Variances have a floor per statistic, since most clean texts have
statistics that are exactly zero and would else form a singular scatter. Groups below
``LEAST`` rows are pooled per language, and if still small over all languages.

Null texts count as empty: no words, base_failed. Null language or source form groups of
their own. Repeated rows each get their row. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partflow.llm.common import SPACE_CHARS, SPACES, WORD, store, text_of
from partflow.operators.sizing import bounded_broadcast

#: Fixed value: the symbols that count.
SYMBOLS = "#*$%&|<>"
#: Rows a group needs for its own estimate; share of rows that a concentration step keeps;
#: number of steps.
LEAST, KEEP, STEPS = 100, 0.75, 3
#: Groups whose estimates are broadcast (some 50 numbers each).
GROUPS = 50_000
#: Least standard deviation of each statistic, in its transformed unit: a deviation this
#: small says nothing about quality.
FLOOR = {"log_words": 0.8, "log_word_len": 0.12, "symbols": 0.05, "dup_lines": 0.12,
         "repeats": 0.12, "upper": 0.1, "marks": 0.15}
#: Chi-square quantiles with 7 degrees of freedom: median, 97.5 %, and the cut (1 - 1e-6).
MEDIAN, INNER, CUT = 6.346, 16.013, 40.522


def text_statistics(text: Column) -> dict[str, Column]:
    """Expressions over one text for its plain counts; ``_words`` needs its own select."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SPACES))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    length = F.length(text)
    return {
        "_words": words,
        "word_chars": F.length(F.translate(text, SPACE_CHARS, "")).cast("long"),
        "n_symbols": (length - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_upper": (length - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
                    ).cast("long"),
        "n_marks": (length - F.length(F.translate(text, "!?", ""))).cast("long"),
    }


def _tail(a: Column) -> Column:
    return F.slice(a, 2, F.greatest(F.size(a) - 1, F.lit(0)))


def repeat_words(rows: DataFrame) -> DataFrame:
    """``_words`` replaced by n_words and n_repeat_words. Windows of three words are compared
    by 64-bit hashes within their text: sorted, equal neighbours repeat, and the words under
    a repeated window are counted once."""
    n = F.size("_words")
    rows = rows.withColumn("n_words", n.cast("long")).withColumn(
        "_words", F.transform("_words", lambda w: F.xxhash64(w)))
    left = F.greatest(n - 2, F.lit(0))
    rows = rows.withColumn("_words", F.arrays_zip(*(
        F.slice("_words", i, left).alias(c) for i, c in ((1, "a"), (2, "b"), (3, "c")))))
    rows = rows.withColumn("_words", F.sort_array(F.transform(
        "_words", lambda x, i: F.struct(F.xxhash64(x["a"], x["b"], x["c"]).alias("h"),
                                        i.alias("i")))))
    same = F.zip_with("_words", _tail(F.col("_words")),
                      lambda x, y: F.when(x["h"] == y["h"], F.array(x["i"], y["i"])))
    rows = rows.withColumn("_words", F.sort_array(F.array_distinct(F.flatten(
        F.filter(same, lambda p: p.isNotNull())))))
    cover = F.zip_with("_words", _tail(F.col("_words")),
                       lambda x, y: F.coalesce(F.least(F.lit(3), y - x), F.lit(3)))
    return rows.withColumn("n_repeat_words", F.aggregate(
        cover, F.lit(0).cast("long"), lambda a, x: a + x)).drop("_words")


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the counts and ``base_failed``."""
    found = text_statistics(text_of(text))
    rows = repeat_words(docs.select(*[F.col(c) for c in docs.columns if c != text],
                                    *[v.alias(k) for k, v in found.items()]))
    return rows.withColumn("base_failed", (F.col("n_words") < 50)
                           | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def vector() -> dict[str, Column]:
    """The transformed statistics."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    return {"log_words": F.log1p("n_words"),
            "log_word_len": F.log(chars / n),
            "symbols": F.log1p(F.col("n_symbols") / n),
            "dup_lines": F.log1p(10.0 * F.col("n_dup_lines") / n),
            "repeats": F.sqrt(F.col("n_repeat_words") / n),
            "upper": F.sqrt(F.col("n_upper") / chars),
            "marks": F.log1p(F.col("n_marks") / n)}


def _estimate(rows: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """Mean, Cholesky factor of the covariance and log determinant per group."""
    d = len(names)
    sums = [F.avg(f"x{i}").alias(f"m{i}") for i in range(d)]
    cross = [F.avg(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"c{i}_{j}")
             for i in range(d) for j in range(i + 1)]
    out = rows.groupBy(*by).agg(*sums, *cross)
    low = [FLOOR[x] ** 2 for x in names]
    out = out.select(*by, *[f"m{i}" for i in range(d)], *[
        (F.col(f"c{i}_{j}") - F.col(f"m{i}") * F.col(f"m{j}")
         + (F.lit(low[i]) if i == j else F.lit(0.0))).alias(f"c{i}_{j}")
        for i in range(d) for j in range(i + 1)])
    # Cholesky, column by column; each select names what the next one reads.
    for j in range(d):
        done = sum((F.col(f"l{j}_{k}") ** 2 for k in range(j)), F.lit(0.0))
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(F.col(f"c{j}_{j}") - done,
                                                            F.lit(low[j]))))
        out = out.withColumns({
            f"l{i}_{j}": (F.col(f"c{i}_{j}") - sum(
                (F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}") for k in range(j)), F.lit(0.0)))
            / F.col(f"l{j}_{j}") for i in range(j + 1, d)})
    det = sum((F.log(f"l{i}_{i}") for i in range(d)), F.lit(0.0)) * 2
    return out.select(*by, *[f"m{i}" for i in range(d)],
                      *[f"l{i}_{j}" for i in range(d) for j in range(i + 1)],
                      det.alias("det"))


def _beside(rows: DataFrame, table: DataFrame, by: str | list[str]) -> DataFrame:
    """``rows`` with their group's row of ``table``, a written table of one row per group. Up to
    ``GROUPS`` groups, by an exact count, it is broadcast, and the rows of a hot group stay
    where they are; a longer one is joined by shuffle, where no group can be most of the
    rows unless it is split by the adaptive skew join."""
    return rows.join(bounded_broadcast(table, GROUPS), by)


def _distance(rows: DataFrame, fit: DataFrame, by: list[str], d: int) -> DataFrame:
    """``rows`` with ``d2``, the squared Mahalanobis distance to their group's fit."""
    rows = _beside(rows, fit, by)
    for i in range(d):
        rows = rows.withColumn(f"z{i}", (F.col(f"x{i}") - F.col(f"m{i}") - sum(
            (F.col(f"l{i}_{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0)))
            / F.col(f"l{i}_{i}"))
    return rows.withColumn("d2", sum((F.col(f"z{i}") ** 2 for i in range(d)), F.lit(0.0)))


def _nearest(rows: DataFrame, by: list[str]) -> DataFrame:
    """The share ``KEEP`` of each group's rows with the smallest ``d2``."""
    at = store(rows.groupBy(*by).agg(F.percentile_approx("d2", KEEP, 2000).alias("at")),
               "mcd-cut")
    return _beside(rows, at, by).where("d2 <= at")


def _code(*cols: str) -> Column:
    return F.xxhash64(F.lit(len(cols)), *[x for c in cols for x in (F.col(c).isNull(),
                                                                    F.col(c))])


def groups(rows: DataFrame) -> DataFrame:
    """both, g: the group of each (language, source) code; language and source, or for few
    rows the language, or all."""
    n = rows.groupBy("both", "lone").agg(F.count("*").alias("n"))
    few = n.where(F.col("n") < LEAST)
    left = few.groupBy("lone").agg(F.sum("n").alias("m"))
    return n.where(F.col("n") >= LEAST).select("both", F.col("both").alias("g")).unionByName(
        few.join(left, "lone").select("both", F.when(F.col("m") >= LEAST, F.col("lone"))
                                      .otherwise(F.lit(0).cast("long")).alias("g")))


def robust_fit(rows: DataFrame, names: list[str]) -> DataFrame:
    """g, mean and Cholesky factor: the reweighted minimum covariance determinant of the rows'
    vectors x0, x1, ... per group. ``rows`` should be a written table."""
    d, by = len(names), ["g", "start"]
    middle = store(rows.groupBy("g").agg(*[
        F.percentile_approx(f"x{i}", 0.5, 2000).alias(f"m{i}") for i in range(d)]), "mcd-middle")
    near = _beside(rows, middle, "g")
    spread = near.groupBy("g").agg(*[
        (F.percentile_approx(F.abs(F.col(f"x{i}") - F.col(f"m{i}")), 0.5, 2000) * 1.4826
         + FLOOR[x]).alias(f"s{i}") for i, x in enumerate(names)])
    near = store(middle.join(spread, "g"), "mcd-spread")
    far = [F.abs(F.col(f"x{i}") - F.col(f"m{i}")) / F.col(f"s{i}") for i in range(d)]
    begun = _beside(rows, near, "g").select(
        "g", *[f"x{i}" for i in range(d)],
        F.explode(F.array(          # by scaled squares, and by the largest single deviation
            F.struct(F.lit(0).alias("start"), sum((x * x for x in far), F.lit(0.0)).alias("d2")),
            F.struct(F.lit(1).alias("start"), F.greatest(*far).alias("d2")))).alias("s"))
    begun = begun.select("g", *[f"x{i}" for i in range(d)], "s.start", "s.d2")
    fit = store(_estimate(_nearest(begun, by), by, names), "mcd-start")
    both = rows.select("g", *[f"x{i}" for i in range(d)]).withColumn(
        "start", F.explode(F.array(F.lit(0), F.lit(1))))
    for step in range(STEPS):
        fit = store(_estimate(_nearest(_distance(both, fit, by, d).select(
            *by, *[f"x{i}" for i in range(d)], "d2"), by), by, names), f"mcd-step{step}")
    best = fit.groupBy("g").agg(F.min(F.struct("det", "start")).alias("best"))
    fit = store(fit.join(best.select("g", F.col("best.start").alias("start")),
                         ["g", "start"]).drop("start"), "mcd-best")
    at = _distance(rows, fit, ["g"], d)
    scale = store(at.groupBy("g").agg(F.percentile_approx("d2", 0.5, 2000).alias("mid")),
                  "mcd-scale")
    inner = _beside(at, scale, "g").where(F.col("d2") * MEDIAN
                                      <= INNER * F.greatest("mid", F.lit(1e-9)))
    return store(_estimate(inner.select("g", *[f"x{i}" for i in range(d)]), ["g"], names),
                 "mcd-fit")


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def judged(docs: DataFrame, text: str, own: list[str]) -> DataFrame:
    """``_own`` (the columns ``own`` as a struct, so that no name clashes), the counts, d2 and
    kept. The estimates come from rows that pass the base rules. The counts are written once;
    the verdict joins the groups' estimates, a small table, to them."""
    names = list(vector())
    rows = statistics(docs.select(F.struct(*own).alias("_own"), F.col(text).alias("_t"),
                                  _code("lang", "source").alias("both"),
                                  _code("lang").alias("lone")), "_t")
    x = [f"x{i}" for i in range(len(names))]
    rows = store(rows.select("_own", "both", "lone", *COUNTS,
                             *[v.alias(c) for c, v in zip(x, vector().values())]),
                 "quality-rows")
    passed = rows.where("not base_failed").select("both", "lone", *x)
    group = store(groups(passed), "quality-groups")
    grouped = store(_beside(passed, group, "both").select("g", *x), "quality-grouped")
    fit = robust_fit(grouped, names)
    inside = _distance(_beside(rows.where("not base_failed"), group, "both"), fit, ["g"],
                       len(x))
    return inside.select("_own", *COUNTS, "d2", (F.col("d2") <= CUT).alias("kept")
                         ).unionByName(
        rows.where("base_failed").select("_own", *COUNTS,
                                         F.lit(None).cast("double").alias("d2"),
                                         F.lit(False).alias("kept")))


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts, base_failed, d2 and kept in place of the text (and of columns
    that bear one of these names)."""
    new = [*COUNTS, "d2", "kept"]
    own = [c for c in docs.columns if c != text and c not in new]
    return judged(docs, text, own).select("_own.*", *new)


def quality_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept."""
    return judged(docs, text, docs.columns).where("kept").select("_own.*")
