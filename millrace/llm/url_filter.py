"""URL filter: host and path rules first, else a ratio of two character language models.

Accepted and rejected URLs each train a smoothed variable-order Markov model
(Witten-Bell interpolation over contexts of 0 to ``order`` characters). A URL's
score is the mean over its characters of the difference of the two models' log
probabilities; the threshold is the one that separates held-out labelled URLs
best. Everything is DataFrame operations.

Edge cases: a null url has empty host and path, no score and is blocked; without
labelled URLs of both kinds every score is 0 and the threshold 0, which allows.
Repeated rows get the same result each.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged

ALLOW, BLOCK = "allow", "block"
_PAD, _END = "\x02", "\x03"
_CHARACTERS = 256.0
_BINS = 100


@dataclass(frozen=True)
class Rule:
    action: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_of(url: Column) -> Column:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The text of the longest rule that fits the host or a parent of it and the start of the path."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def _grams(df: DataFrame, order: int) -> DataFrame:
    """The columns of ``df`` and, a row per character of url and its end, the character after ``order`` others."""
    padded = F.concat(F.lit(_PAD * order), F.col("url"), F.lit(_END))
    at = F.sequence(F.lit(1), F.length("url") + 1)
    return df.select("*", F.explode(F.transform(at, lambda i: F.substring(padded, i, F.lit(order + 1)))).alias("gram"))


def _smoothed(counts: DataFrame, needed: DataFrame, order: int) -> DataFrame:
    """The log ratio of the two models' probabilities for each needed gram.

    ``counts`` has (gram, yes, no). Each order's probabilities come from the order
    below, for the distinct endings of the needed grams, and are staged: five nested
    levels in one plan would weigh on the driver.
    """
    total = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("yes", "no"))).first()
    both = total["yes"] > 0 and total["no"] > 0
    if not both:
        return needed.select("gram", F.lit(0.0).alias("ratio"))
    below = None
    for m in range(order + 1):
        tail = F.expr(f"right(gram, {m + 1})")
        seen = counts.groupBy(tail.alias("tail")).agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        context = seen.groupBy(F.expr(f"left(tail, {m})").alias("context")).agg(
            F.sum("yes").alias("n_yes"),
            F.sum("no").alias("n_no"),
            F.count_if(F.col("yes") > 0).alias("t_yes"),
            F.count_if(F.col("no") > 0).alias("t_no"),
        )
        want = needed.select(tail.alias("tail")).distinct()
        if m == 0:
            first = context.first()
            want = want.withColumns({"p_yes": F.lit(1 / _CHARACTERS), "p_no": F.lit(1 / _CHARACTERS)})
            want = want.withColumns({c: F.lit(first[c]) for c in ("n_yes", "n_no", "t_yes", "t_no")})
        else:
            shorter = below.withColumnRenamed("tail", "ending")
            want = want.withColumns({"ending": F.expr(f"right(tail, {m})"), "context": F.expr(f"left(tail, {m})")})
            want = want.join(shorter, "ending").join(context, "context", "left")
        want = want.join(seen, "tail", "left").fillna(0)
        p = {
            k: (F.col(k) + F.col(f"t_{k}") * F.col(f"p_{k}")) / F.greatest(F.col(f"n_{k}") + F.col(f"t_{k}"), F.lit(1))
            for k in ("yes", "no")
        }
        unseen = {k: F.when(F.col(f"n_{k}") > 0, p[k]).otherwise(F.col(f"p_{k}")) for k in p}
        below = staged(want.select("tail", unseen["yes"].alias("p_yes"), unseen["no"].alias("p_no")), "probabilities")
    return below.select(F.col("tail").alias("gram"), F.log(F.col("p_yes") / F.col("p_no")).alias("ratio"))


def score_urls(urls: DataFrame, labelled: DataFrame, order: int = 4) -> DataFrame:
    """(url, score) for each distinct url; ``labelled`` has (url, accepted)."""
    counts = staged(
        _grams(labelled.where("url IS NOT NULL"), order)
        .groupBy("gram")
        .agg(F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no")),
        "grams",
    )
    # staged and dealt by rows: AQE would put all URLs into one task by their bytes, which are few before the explode
    distinct = staged(urls.select("url").where("url IS NOT NULL").distinct(), "urls")
    parts = int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    positions = _grams(distinct.repartition(parts, "url"), order)
    ratios = _smoothed(counts, staged(positions.select("gram").distinct(), "needed"), order)
    return staged(positions.join(ratios, "gram").groupBy("url").agg(F.avg("ratio").alias("score")), "scores")


def best_threshold(scored: DataFrame) -> float:
    """The score from which on accepting gives the best mean of both kinds' hit rates.

    ``scored`` has (score, accepted); scores are counted in at most 4,001 steps.
    """
    step = F.floor(F.greatest(F.least(F.col("score"), F.lit(20.0)), F.lit(-20.0)) * _BINS)
    bins = (
        scored.where("score IS NOT NULL")
        .groupBy(step.alias("step"))
        .agg(F.count_if("accepted").alias("yes"), F.count_if(~F.col("accepted")).alias("no"))
        .orderBy("step")
        .collect()
    )
    yes, no = sum(b["yes"] for b in bins), sum(b["no"] for b in bins)
    if not yes or not no:
        return 0.0
    best, at, kept, passed, below = -1.0, 0.0, yes, no, bins[0]["step"] - 1
    for b in bins:
        if (value := kept / yes + 1 - passed / no) > best:
            best, at = value, (below + 1 + b["step"]) / 2 / _BINS  # halfway between the scores to both sides
        kept, passed, below = kept - b["yes"], passed - b["no"], b["step"]
    return at


def judge_urls(pages: DataFrame, rules: Sequence[Rule], order: int = 4, folds: int = 5) -> DataFrame:
    """Every page with host, path, rule, score and verdict.

    URLs that a rule decides are the labelled ones: all but each ``folds``-th (by
    crc32 of the url) train the models, the rest calibrate the threshold.
    """
    allowed = [r.text for r in rules if r.action == ALLOW]
    own = pages.select("page_id", "url").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    ruled = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    known = ruled.where("rule IS NOT NULL AND url IS NOT NULL").select("url", F.col("rule").isin(allowed).alias("accepted"))
    held = F.crc32(F.col("url").cast("binary")) % folds == 0
    scores = score_urls(ruled.select("url"), known.where(~held), order)
    scored = ruled.join(scores.withColumnRenamed("url", "scored_url"), F.col("url") == F.col("scored_url"), "left")
    threshold = best_threshold(known.where(held).join(scores, "url"))
    by_rule = F.when(F.col("rule").isin(allowed), ALLOW).otherwise(BLOCK)
    by_score = F.when(F.col("score") >= threshold, ALLOW).otherwise(BLOCK)
    return scored.select(
        "page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_score).alias("verdict"), "score"
    )
