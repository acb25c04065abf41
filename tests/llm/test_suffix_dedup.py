import hashlib
from collections import Counter

import numpy as np
import pytest

from cases import awkward, empty, nothing
from playlens.llm import suffix_dedup as sd


def brute(rows, length=sd.LENGTH):
    """Per row: bytes, removed, spans, sha of the rest."""
    raw = [(d, (t or "").encode()) for d, t in rows]
    count = Counter(b[i:i + length] for _, b in raw for i in range(len(b) - length + 1))
    out = []
    for d, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i:i + length]] > 1:
                gone[i:i + length] = True
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((d, len(b), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize("hot", [sd.HOT_CLASSES, 2])
def test_matches_brute_force(spark, hot):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = sd.remove_duplicate_substrings(docs, hot_classes=hot)
    assert result(got) == brute(rows)
    later = {r["doc_id"]: r for r in got.collect()}
    assert sum(r["n_removed_later"] for r in later.values()) < sum(r["n_removed"] for r in later.values())


def test_repeats_inside_one_text_and_periodic_text(spark):
    piece = hashlib.sha512(b"piece").hexdigest() + hashlib.sha512(b"more").hexdigest()[:102]
    rows = [(1, piece + "|" + piece), (2, "ab" * 400), (3, "x" + piece[:199]), (4, "é" * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sd.remove_duplicate_substrings(docs)
    assert result(got) == brute(rows)
    first = {r["doc_id"]: r for r in got.collect()}[1]
    assert (first["n_removed"], first["n_removed_later"]) == (460, 230)


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert result(sd.remove_duplicate_substrings(docs)) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_empty_tables(spark):
    assert sd.remove_duplicate_substrings(empty(spark)).count() == 0
    assert result(sd.remove_duplicate_substrings(nothing(spark))) == brute([(None, None)] * 3)


def test_previous_factors_against_all_pairs():
    text = b"abracadabra_abracadabra"
    order = np.array(sorted(range(len(text)), key=lambda i: text[i:]))

    def common(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n
    lcp = np.array([0] + [common(order[k - 1], order[k]) for k in range(1, len(order))])
    best, source = sd.previous_factors(lcp, order)
    for k, i in enumerate(order):
        assert best[k] == max([common(i, j) for j in range(i)], default=0)
        assert best[k] == 0 or (order[source[k]] < i and common(i, order[source[k]]) == best[k])


@pytest.mark.parametrize("odd_rows", ["one id, two texts", "null id, known text"])
def test_ids_that_do_not_name_one_text(spark, odd_rows):
    text = ["".join(hashlib.sha512(f"{k}/{i}".encode()).hexdigest() for i in range(5)) for k in range(4)]
    shared = text[3][:300]
    rows = [(3, text[0]), (6, text[1] + shared), (7, text[2])]
    rows += [(5, text[0]), (5, shared + text[2][:150])] if odd_rows == "one id, two texts" else [(None, text[0]), (8, shared)]
    got = sd.remove_duplicate_substrings(spark.createDataFrame(rows, "doc_id long, text string"))
    assert result(got) == brute(rows)
    later = Counter((r["doc_id"], r["n_removed_later"] == r["n_bytes"]) for r in got.collect())
    assert later[3, False] == 1 and later[5 if odd_rows == "one id, two texts" else None, True] == 1
