"""Quality rules: two base rules, and multivariate outliers by minimum covariance determinant estimates.

DataFrame functions only. One projection counts words, characters in them, symbols,
repeated lines and words in repeated windows of every whole text. Five transformed
statistics of the texts that pass the base rules form a vector. For every language and
source, the mean and covariance of the three quarters of its rows that lie closest
together are found by concentration steps: from medians and quartiles on, each step
measures all rows by the present estimate and takes the moments of the closest ones.
A reweighted estimate follows, and a text is rejected if its squared Mahalanobis
distance exceeds the chi-squared quantile of ``TAIL``.

Nothing is sampled. A step is one aggregation of all rows by language, source and bin of
the distance, combined in every task; the bins that hold the closest rows are added up,
so no order statistic needs a sort. Vectors are whole numbers of 1/``SCALE``, whose sums
are exact in any order, so estimates are the same in every run. Estimates are a row per
language and source, joined by whatever way Spark finds for their measured size.

Small groups: ``PRIOR`` rows of the moments of all groups together are added to each
group's own, and each variance has a floor (``FLOORS``), so every covariance is positive.

Edge cases: a null or empty text has no words and fails the base rules; null languages and
sources are groups of their own; every row is judged by itself and counts for itself,
whatever its id; equal texts of a group have equal verdicts. A text without words in its
lines has no repeated lines. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.common import staged

#: What separates words, and the symbols that are counted.
BLANKS, SYMBOLS = r"[\x20\x09-\x0D]+", "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

#: The statistics' names and the least standard deviation of each.
FLOORS = {"length": 0.1, "word_length": 0.04, "symbols": 0.1, "repeated_lines": 0.25, "repeated_words": 0.08}
SCALE, PRIOR, CLOSEST, STEPS = 256, 20, 0.75, 4
REWEIGHT, TAIL = 0.975, 1 - 1e-6
#: Distances are told apart by steps of 1/16 in ln(1 + d2), up to the last bin.
_FINE, _LAST = 16, 255
_P = len(FLOORS)
_PAIRS = [(i, j) for i in range(_P) for j in range(i + 1)]
_GROUP = ("lang", "source")
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _covered(windows: Column) -> Column:
    """Words in the windows of three words that occur twice or more."""
    placed = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("w"), i.alias("i"))))

    def again(s: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            return x["w"].eqNullSafe(F.get(s, k - 1)["w"]) | x["w"].eqNullSafe(F.get(s, k + 1)["w"])

        return F.array_sort(F.transform(F.filter(s, same), lambda x: x["i"]))

    def words(at: Column) -> Column:
        new = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return F.aggregate(new, F.lit(0), lambda a, b: a + b)

    return _let(placed, lambda s: _let(again(s), words))


def _word_counts(words: Column) -> Column:
    def counts(w: Column) -> Column:
        def window(x: Column, i: Column) -> Column:
            return F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2))

        def repeated(windows: Column) -> Column:
            unlike = F.size(F.array_distinct(windows)) == F.size(windows)
            return F.when(unlike, 0).otherwise(_covered(windows))

        windows = F.transform(F.slice(w, F.lit(1), F.size(w) - 2), window)
        n_repeat = F.when(F.size(w) < 4, 0).otherwise(_let(windows, repeated))
        return F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), n_repeat.alias("repeat"))

    return _let(words, counts)


def text_counts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, the five counts, base_failed) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, BLANKS), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = docs.select(
        "doc_id",
        *_GROUP,
        _word_counts(words).alias("of_words"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
    )
    values = {"n_words": "of_words.n", "word_chars": "of_words.chars", "n_repeat_words": "of_words.repeat"}
    columns = [F.col(values.get(c, c)).cast("long").alias(c) for c in _COUNTS]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return counted.select("doc_id", *_GROUP, *columns).withColumn("base_failed", failed)


def _vector() -> list[Column]:
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    values = (
        F.ln(n),
        F.ln(F.greatest(F.col("word_chars"), F.lit(1)) / n),
        F.ln(1 + 4 * F.col("n_symbols") / n),
        F.ln(1 + 100 * F.col("n_dup_lines") / n),
        F.col("n_repeat_words") / n,
    )
    return [F.round(v * SCALE).cast("long").alias(f"x{i}") for i, v in enumerate(values)]


def chi_squared(x: float, k: int) -> float:
    """The distribution function of the chi-squared law of ``k`` degrees, by the series of the incomplete gamma function."""
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a))) if x else 0.0


def chi_squared_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_squared(mid, k) < p else (low, mid)
    return high


def consistency(share: float) -> float:
    """What the covariance of the closest ``share`` of a normal sample is multiplied with."""
    return share / chi_squared(chi_squared_quantile(share, _P), _P + 2)


def _first_estimate(stats: DataFrame) -> DataFrame:
    """(lang, source, m0 .., w00 ..): medians, and the quartiles' distance as deviation; exact, by counted values."""
    values = stats.select(*_GROUP, F.posexplode(F.array(*(f"x{i}" for i in range(_P)))).alias("i", "x"))
    counted = values.groupBy(*_GROUP, "i", "x").agg(F.count(F.lit(1)).alias("n"))
    one = Window.partitionBy(*_GROUP, "i")
    upto, whole = F.sum("n").over(one.orderBy("x")), F.sum("n").over(one)
    placed = counted.select(*_GROUP, "i", "x", upto.alias("upto"), whole.alias("whole"))

    def quantile(i: int, quarter: int) -> Column:
        return F.min(F.when((F.col("i") == i) & (4 * F.col("upto") >= quarter * F.col("whole")), F.col("x"))) / SCALE

    spread = [((quantile(i, 3) - quantile(i, 1)) / 1.349) for i in range(_P)]
    means = [quantile(i, 2).alias(f"m{i}") for i in range(_P)]
    scales = [
        ((1 / F.sqrt(s * s + floor * floor)) if i == j else F.lit(0.0)).alias(f"w{i}{j}")
        for (i, j), s, floor in ((p, spread[p[0]], list(FLOORS.values())[p[0]]) for p in _PAIRS)
    ]
    return staged(placed.groupBy(*_GROUP).agg(*means, *scales), "rules-estimate")


def _measured(stats: DataFrame, estimate: DataFrame, how: str = "inner") -> DataFrame:
    """The rows with ``d2``, their squared Mahalanobis distance from their group's estimate."""
    model = estimate.withColumnsRenamed({g: f"_{g}" for g in _GROUP})
    joined = stats.join(model, [stats[g].eqNullSafe(model[f"_{g}"]) for g in _GROUP], how)
    d2 = F.lit(0.0)
    for i in range(_P):
        z = F.lit(0.0)
        for j in range(i + 1):
            z += F.col(f"w{i}{j}") * (F.col(f"x{j}") / SCALE - F.col(f"m{j}"))
        d2 += z * z
    return joined.select(*(stats[c] for c in stats.columns), d2.alias("d2"))


def _moments() -> list[Column]:
    firsts = [F.sum(f"x{i}").alias(f"s{i}") for i in range(_P)]
    seconds = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}{j}") for i, j in _PAIRS]
    return [F.count(F.lit(1)).alias("n"), *firsts, *seconds]


_SUMS = ["n", *(f"s{i}" for i in range(_P)), *(f"s{i}{j}" for i, j in _PAIRS)]


def _closest(measured: DataFrame, share: float) -> DataFrame:
    """The moments of each group's closest rows: whole bins of distance, until they hold the share."""
    bin_of = F.least(F.floor(_FINE * F.ln(1 + F.col("d2"))), F.lit(_LAST)).alias("bin")
    bins = measured.groupBy(*_GROUP, bin_of).agg(*_moments())
    one = Window.partitionBy(*_GROUP)
    before = F.sum("n").over(one.orderBy("bin")) - F.col("n")
    kept = bins.withColumns({"_before": before, "_whole": F.sum("n").over(one)}).where(F.col("_before") < share * F.col("_whole"))
    return kept.groupBy(*_GROUP).agg(*(F.sum(c).alias(c) for c in _SUMS))


def _estimate(moments: DataFrame, factor: float) -> DataFrame:
    """(lang, source, m0 .., w00 ..) of groups' moments: means, and the inverse of the covariance's Cholesky factor."""
    moments = staged(moments, "rules-moments")
    whole = moments.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS)).first()
    rows = F.col("n") + PRIOR
    mean = {c: (F.col(c) + PRIOR * whole[c] / max(whole["n"], 1)) / rows for c in _SUMS[1:]}
    model = moments.select(*_GROUP, *(v.alias(c) for c, v in mean.items()))
    floors = list(FLOORS.values())
    covariance = {}
    for i, j in _PAIRS:
        value = factor * (F.col(f"s{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}")) / SCALE**2
        covariance[f"a{i}{j}"] = value + floors[i] ** 2 if i == j else value
    model = model.withColumns(covariance)
    for j in range(_P):  # a column of the factor needs those before it
        rest = {i: F.col(f"a{i}{j}") - _dot((f"l{i}{k}", f"l{j}{k}") for k in range(j)) for i in range(j, _P)}
        model = model.withColumn(f"l{j}{j}", F.sqrt(F.greatest(rest[j], F.lit(floors[j] ** 2))))
        model = model.withColumns({f"l{i}{j}": rest[i] / F.col(f"l{j}{j}") for i in range(j + 1, _P)}) if j + 1 < _P else model
    for i in range(_P):  # a row of the inverse likewise
        own = {f"w{i}{j}": -_dot((f"l{i}{k}", f"w{k}{j}") for k in range(j, i)) / F.col(f"l{i}{i}") for j in range(i)}
        model = model.withColumns(own | {f"w{i}{i}": 1 / F.col(f"l{i}{i}")})
    means = [(F.col(f"s{i}") / SCALE).alias(f"m{i}") for i in range(_P)]
    return staged(model.select(*_GROUP, *means, *(f"w{i}{j}" for i, j in _PAIRS)), "rules-estimate")


def _dot(pairs: Sequence[tuple[str, str]]) -> Column:
    total = F.lit(0.0)
    for a, b in pairs:
        total += F.col(a) * F.col(b)
    return total


def estimates(stats: DataFrame, steps: int = STEPS) -> DataFrame:
    """The reweighted estimates of every language and source of staged rows (lang, source, x0 ..)."""
    estimate = _first_estimate(stats)
    for _ in range(steps):
        estimate = _estimate(_closest(_measured(stats, estimate), CLOSEST), consistency(CLOSEST))
    near = _measured(stats, estimate).where(F.col("d2") <= chi_squared_quantile(REWEIGHT, _P))
    return _estimate(near.groupBy(*_GROUP).agg(*_moments()), consistency(REWEIGHT))


def judge_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, the five counts, base_failed, kept, distance) of every row; a failed row has no distance."""
    counts = staged(text_counts(docs), "rules-counts")
    stats = counts.where("NOT base_failed").select(*_GROUP, *_vector())
    estimate = estimates(stats)
    measured = _measured(counts.withColumns({f"x{i}": v for i, v in enumerate(_vector())}), estimate, "left")
    distance = F.when(~F.col("base_failed"), F.sqrt("d2"))
    kept = ~F.col("base_failed") & F.coalesce(F.col("d2") <= chi_squared_quantile(TAIL, _P), F.lit(True))
    return measured.select("doc_id", *_COUNTS, "base_failed", kept.alias("kept"), distance.alias("distance"))
