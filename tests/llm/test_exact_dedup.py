import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from waypost.llm.exact_dedup import drop_copies, exact_groups

SCHEMA = "doc_id long, text string, n_bytes string, name string"


def norm(text):
    return re.sub("[ \t-\r]+", " ", text or "")


def brute(rows):
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def texts():
    r = random.Random(3)
    words = ["ab", "é", "漢", "x\ty", " ", "zz  z", "😀"]
    made = ["".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 9, 40, 200]))) for _ in range(120)]
    made += [None, "", " ", "a" * 5000, "a" * 5001, "a" * 4999 + "b", "a" * 5000]
    return [(i, t) for i, t in enumerate(made)] + [(500 + i, t) for i, t in enumerate(made[::3])]


@pytest.mark.parametrize("bits", [64, 2])
def test_equals_brute_force_even_with_shared_fingerprints(spark, bits):
    rows = texts() + [(None, "only"), (None, "a" * 5000), (7, "again"), (7, "again")]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    weak = lambda c: F.xxhash64(c).bitwiseAND(F.lit(3)) if bits == 2 else F.xxhash64(c)
    got = exact_groups(docs, block=16, hashing=weak)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_empty_table(spark):
    assert exact_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_drop_copies_keeps_the_smallest_id_and_all_columns(spark):
    docs = spark.createDataFrame([(3, "a b", "p", None), (1, "a\n b", "q", "r"), (2, "c", None, None), (2, "c", None, None)], SCHEMA)
    got = drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == [1, 2]
