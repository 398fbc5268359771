"""Manifests against a tree built in plain Python."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lendspark.llm import merkle

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def hashed(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    parts = ["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS]
    return hashed(*parts)


def tree(hashes):
    levels = [hashes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([hashed(*low[k : k + 2]) for k in range(0, len(low), 2)])
    return levels


def proof(levels, at):
    siblings = []
    for low in levels[:-1]:
        if at ^ 1 < len(low):
            siblings.append(low[at ^ 1])
        at >>= 1
    return "".join(siblings)


def brute(rows):
    """Sorted ``(doc_id, leaf, subroot, root, proof)``."""
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append(((row["doc_id"] is not None, row["doc_id"] or 0), leaf(row), row["doc_id"]))
    names = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    under = {name: tree([h for _, h, _ in sorted(groups[name], key=lambda r: r[:2])]) for name in names}
    top = tree([under[name][-1][0] for name in names])
    found = []
    for g, name in enumerate(names):
        for k, (_, h, doc_id) in enumerate(sorted(groups[name], key=lambda r: r[:2])):
            found.append((doc_id, h, under[name][-1][0], top[-1][0], proof(under[name], k) + proof(top, g)))
    return sorted(found, key=repr)


def ours(df, **kwargs):
    hexed = lambda x: bytes(x).hex()
    rows = merkle.verified(merkle.manifest(df, **kwargs)).collect()
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in rows)
    return sorted(
        [(r["doc_id"], *[hexed(r[c]) for c in ("leaf", "subroot", "root", "proof")]) for r in rows], key=repr
    )


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("block", [1, 2, 10])
def test_trees_of_many_sizes(spark, block):
    sizes = {"a": 1, "b": 2, "c": 3, "ü": 5, None: 9, "": 7, "d": 33}
    rows = [(1000 * k + i, f"text {i}", name, "s", i) for k, (name, n) in enumerate(sizes.items()) for i in range(n)]
    df = table(spark, rows).repartition(5)
    assert ours(df, block_levels=block) == brute([r.asDict() for r in df.collect()])


def test_a_larger_tree_and_many_groups(spark):
    rows = [(i, f"t{i}", "en" if i % 3 else f"l{i}", None, None) for i in range(3000)]
    df = table(spark, rows)
    assert ours(df) == brute([r.asDict() for r in df.collect()])


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(None, None, None, None, None)] * 3 + [(5, "x", "en", "s", 1)] * 4 + [(5, "y", "en", "s", 1), (6, "", "en", "", 0)]
    df = table(spark, rows)
    expected = brute([r.asDict() for r in df.collect()])
    names = ["group", "index", "size", "digest", "segment", "tie", "key", "level", "kind", "root", "range"]
    assert ours(df.withColumns({name: F.lit("c") for name in names})) == expected


def test_one_row_and_none(spark):
    row = (1, "only", "en", "s", 4)
    (found,) = ours(table(spark, [row]))
    digest = leaf(dict(zip(["doc_id", "text", "lang", "source", "n_chars"], row)))
    assert found == (1, digest, digest, digest, "")
    assert merkle.verified(merkle.manifest(table(spark, []))).count() == 0


def test_a_changed_leaf_does_not_verify(spark):
    df = table(spark, [(i, f"t{i}", "en", "s", i) for i in range(20)])
    changed = merkle.leaf_digest([F.col(f) if f != "text" else F.concat("text", F.lit("!")) for f in FIELDS])
    rows = merkle.manifest(df, carry={"claimed": F.when(F.col("doc_id") < 7, changed)})
    checked = merkle.verified(rows.withColumn("claimed", F.coalesce("claimed", "leaf")), "claimed").collect()
    assert all(r["verified"] == (r["doc_id"] >= 7) for r in checked)


def test_many_subroots_are_joined_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    df = table(spark, [(i, "t", f"l{i % 7}", "s", 1) for i in range(100)])
    assert ours(df) == brute([r.asDict() for r in df.collect()])


def test_proofs_have_as_many_digests_as_there_are_siblings(spark):
    df = table(spark, [(i, "t", "en", "s", 1) for i in range(1025)])
    by_id = {r["doc_id"]: r for r in merkle.manifest(df).collect()}
    assert len(by_id[0]["proof"]) == 11 * merkle.DIGEST and len(by_id[1024]["proof"]) == merkle.DIGEST
    place = by_id[1024]
    assert merkle.fold(place["leaf"], place["proof"], [(1024, 1025), (0, 1)]) == place["root"]
