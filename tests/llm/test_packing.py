import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from millrace.llm import packing as P
from millrace.llm.common import ship, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_hilbert_curve_visits_every_cell_by_single_steps():
    side = 8
    cells = np.stack(np.meshgrid(*[np.arange(side)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = P.hilbert_key(cells, 3)
    assert sorted(keys) == list(range(side**3))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_fast_ids_are_those_of_the_tokenizer():
    texts = ["plain text", "façade  naïve\n\n\tx", "日本語   wide", "<|endoftext|>", "a\x00b\x85c\xa0d", "", "  lead 12345!!?", "x" * 3000]
    slow = Tokenizer.from_file(PATH)
    want = [slow.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in P.encoder(PATH)(texts)] == want


def check_pieces(rows, texts):
    """Every document's ids lie in its pieces once, and sequences have no gaps and, but the last, no padding."""
    slow = Tokenizer.from_file(PATH)
    want = sorted(tuple(slow.encode(t or "", add_special_tokens=False).ids) + (0,) for t in texts.values())
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at and n > 0
            at += n
    full = [sum(n for _, n in p) for _, p in sorted(sequences.items())]
    assert sorted(sequences) == list(range(len(full))) and all(n == 1024 for n in full[:-1]) and full[-1] <= 1024
    assert sum(full) == sum(map(len, want))


def test_round_trip(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [r.asDict() for r in P.pack(docs, PATH).collect()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    check_pieces(rows, texts)
    slow, by_doc = Tokenizer.from_file(PATH), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
    assert by_doc.keys() == texts.keys()
    for i, pieces in by_doc.items():
        ids, at = [*slow.encode(texts[i], add_special_tokens=False).ids, 0], 0
        for r in sorted(pieces, key=lambda r: r["start"]):
            part = np.array(ids[at : at + r["length"]], "<u4")
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part.tobytes())
            at += r["length"]
        assert at == len(ids)


def test_neighbours_lie_closer_than_chance(spark):
    """Documents of one language get together along the curve."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    firsts = [r for r in P.pack(docs, PATH).collect() if r.start == 0]
    order = [lang[r.doc_id] for r in sorted(firsts, key=lambda r: (r.sequence_id, r.offset))]
    same = sum(a == b for a, b in zip(order, order[1:])) / (len(order) - 1)
    chance = sum((order.count(x) / len(order)) ** 2 for x in set(order))
    assert same > chance + 0.15


def test_awkward_documents(spark, awkward, no_documents):
    ship(spark)
    rows = P.pack(awkward, PATH)
    assert rows.columns == COLUMNS
    found = [r.asDict() for r in rows.collect()]
    check_pieces(found, dict(enumerate(r.text for r in awkward.collect())))
    assert {r["doc_id"] for r in found} == {r.doc_id for r in awkward.collect()}
    assert sum(r["doc_id"] in (3, 4) for r in found) == 2 and all(r["length"] == 1 for r in found if r["doc_id"] in (3, 4))
    assert P.pack(no_documents, PATH).count() == 0
