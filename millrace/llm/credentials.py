"""Secret scan with linking of the parts of a credential.

Base kinds (``BASE``) are reported wherever they match. Weak candidates, which alone
mean nothing, are account ids, bare keys and endpoints: identifiers, secrets and
places to use them. Every part opens a scope of ``scope`` characters to both sides;
an interval join of the parts of a document over a grid of that width finds which
others begin inside it. A weak candidate is reported only if an identifier, a secret
and an endpoint meet in its scope, itself included; base matches count as parts too.

Edge cases: a null or empty text has no parts; parts found by several kinds at one
place are reported by each; repeated rows are scanned each on its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import fresh, staged

# The base kinds in the order in which they are listed, and their least lengths.
BASE = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS, _HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
_ASSIGN_LEAST, _ACCESS_LEAST = 8, 16
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Weak kinds: what part of a credential each is, and its pattern. They have least lengths only, and take whole runs.
WEAK = {
    "account": ("identifier", re.compile(r"\b(?:user|login|account|client_id)\b[\"']?\x20?[:=]\x20?[\"']?[\w.@-]{3,}+", re.ASCII)),
    "key": ("secret", re.compile(r"(?<![\w+/-])(?=[A-Za-z_+/]*+[0-9])(?=[0-9_+/]*+[A-Za-z])[\w+/]{20,}+={0,2}+(?![\w+/=-])", re.ASCII)),
    "endpoint": ("endpoint", re.compile(r"\b(?:https?|jdbc:\w+|postgres|mysql|amqp|redis|s3)://[^\s\"'<>|]{4,}+", re.ASCII)),
}
KINDS = (*BASE, *WEAK)
_PART_OF = {"assign": "secret", "access": "identifier", "hex": "secret"} | {k: part for k, (part, _) in WEAK.items()}
_LONG = re.compile(r"[\w+/]{20}", re.ASCII)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place in KINDS, end) of the base kinds' matches in order."""
    spans = []
    lower = text.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def weak_spans(text: str) -> list[tuple[int, int, int]]:
    """The same of the weak kinds; keys only where a long run of key characters is."""
    spans = []
    for i, (kind, (_, pattern)) in enumerate(WEAK.items(), len(BASE)):
        if kind == "endpoint" and "://" not in text or kind == "key" and not _LONG.search(text):
            continue
        spans += [(m.start(), i, m.end()) for m in pattern.finditer(text)]
    return sorted(spans)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _scan(column_names: list[str]):
    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(base_spans(t or ""), weak_spans(t or "")) for t in batch.pop("text")]
            batch["base"] = [[[*s] for s in base] for base, _ in found]
            batch["weak"] = [[[*s] for s in weak] for _, weak in found]
            batch["n"] = [[sum(k == i for _, k, _ in base) for i in range(len(BASE))] for base, _ in found]
            batch["base_sha256"] = [hashlib.sha256(spelled(base).encode()).hexdigest() for base, _ in found]
            yield batch[column_names]

    return scan


def linked_parts(parts: DataFrame, scope: int) -> DataFrame:
    """The weak ones of the parts (row, kind, start, stop) with all three kinds of part in their scope.

    A part is known by the grid cell of its start and looks for others there and in
    the two neighbouring cells, so a pair meets once.
    """
    part = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(i), F.lit(_PART_OF[k]))])
    cell = F.floor(F.col("start") / scope)
    near = parts.select("row", F.col("start").alias("at"), part[F.col("kind")].alias("part"), cell.alias("cell"))
    near = near.groupBy("row", "cell", "part").agg(F.array_sort(F.collect_set("at")).alias("at"))
    weak = parts.where(F.col("kind") >= len(BASE)).withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    inside = F.exists("at", lambda x: F.abs(x - F.col("start")) <= scope)
    return (
        weak.join(near, ["row", "cell"])
        .where(inside)
        .groupBy("row", "kind", "start", "stop")
        .agg(F.count_distinct("part").alias("parts"))
        .where("parts = 3")
        .drop("parts")
    )


def _scanned(docs: DataFrame) -> DataFrame:
    """Each row's key, base and weak spans, without the text. The key is the row's content: equal rows, equal results."""
    span = "array<array<int>>"
    # Ids pass through pandas as text, since a null among integers would turn them into doubles there.
    columns = {"doc_id": "string", "row": "long", "base": span, "weak": span, "n": "array<long>", "base_sha256": "string"}
    rows = docs.select(F.col("doc_id").cast("string"), "text", F.xxhash64("doc_id", "text").alias("row"))
    found = staged(rows.mapInPandas(_scan(list(columns)), ", ".join(f"{k} {v}" for k, v in columns.items())), "secrets")
    return found.withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]))


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """(row, linked): the weak spans to report. Only documents with all three kinds of part can link any."""
    kinds = F.transform(F.concat("base", "weak"), lambda s: F.element_at(s, 2))
    has = lambda part: F.arrays_overlap(kinds, F.array(*[F.lit(i) for i, k in enumerate(KINDS) if _PART_OF[k] == part]))
    s = F.col("s")
    parts = (
        found.where((F.size("weak") > 0) & has("identifier") & has("secret") & has("endpoint"))
        .select("row", F.explode(F.concat("base", "weak")).alias("s"))
        .select("row", s[1].alias("kind"), s[0].alias("start"), s[2].alias("stop"))
    )
    return linked_parts(parts, scope).groupBy("row").agg(F.collect_set(F.array("start", "kind", "stop")).alias("linked"))


def scan_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) for each document."""
    found = _scanned(docs)
    names = F.array(*map(F.lit, KINDS))
    every = F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast("array<array<int>>"))))
    text = F.transform(every, lambda x: F.concat_ws(":", F.get(names, x[1]), x[0].cast("string"), x[2].cast("string")))
    return found.join(_linked(found, scope), "row", "left").select(
        "doc_id",
        *(F.col("n")[i].alias(f"n_{k}") for i, k in enumerate(BASE)),
        "base_sha256",
        F.concat_ws(",", text).alias("spans"),
        F.coalesce(F.array_size("linked"), F.lit(0)).cast("long").alias("n_linked"),
    )


def mask_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """The documents with every reported span overwritten by asterisks, so that lengths and offsets stay."""
    row, linked = fresh(*docs.columns), fresh(*docs.columns)
    extra = _linked(_scanned(docs), scope).select(F.col("row").alias(row), F.col("linked").alias(linked))

    @F.pandas_udf("string")
    def mask(texts: pd.Series, more: pd.Series) -> pd.Series:
        def one(text: str | None, spans) -> str | None:
            for start, _, stop in [*base_spans(text or ""), *([] if spans is None else spans)]:
                text = text[:start] + "*" * (stop - start) + text[stop:]
            return text

        return pd.Series([one(t, s) for t, s in zip(texts, more, strict=True)], dtype=object)

    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text")).join(extra, row, "left")
    return keyed.withColumn("text", mask("text", linked)).select(docs.columns)
