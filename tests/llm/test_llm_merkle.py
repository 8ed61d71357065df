"""Merkle manifests against trees that are built whole, in Python."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import cases
from llm import merkle, queries
from llm.common import Scratch


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_leaf(row, text):
    parts = []
    for v in (row[0], row[3], row[2], row[4], text):
        v = None if v is None else str(v)
        parts.append("-" if v is None else f"{len(v.encode())}:{v}")
    return h(*parts)


def brute_tree(nodes, fan=3):
    """The top and every node's siblings as (left, right) texts by level."""
    proofs = [[] for _ in nodes]
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf, i in enumerate(at):
            first = i - i % fan
            proofs[leaf].append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + fan])))
        nodes = [h(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        at = [i // fan for i in at]
    return nodes[0], proofs


def brute(docs):
    groups = collections.defaultdict(list)
    for row in docs:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    found, tops = [], []
    for source in order:
        rows = sorted(groups[source], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r, r[1])))
        leaves = [brute_leaf(r, r[1]) for r in rows]
        top, proofs = brute_tree(leaves)
        tops.append(top)
        found.append(list(zip(rows, leaves, proofs, strict=True)))
    root, above = brute_tree(tops)
    out = []
    for subroot, upper, rows in zip(tops, above, found, strict=True):
        for row, leaf, proof in rows:
            proof = proof + upper
            text = row[1]
            if text is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            digest = brute_leaf(row, text)
            for left, right in proof:
                digest = h(left, digest, right)
            out.append((row[0], leaf, subroot, root, h(*[a + b for a, b in proof]), digest, digest == root))
    return out


def many():
    """Groups of every size around the powers of three, one of them large."""
    docs, i = [], 0
    for size in [*range(1, 12), 26, 27, 28, 81, 82, 700]:
        for k in range(size):
            docs.append((i, f"text {k % 3}\nof {size}\n" * (k % 4), "en", f"s{size}" if size % 5 else None, k))
            i += 1
    docs += [docs[3], docs[3], (None, "a\nb", None, "é", None), (-5, "\n", None, "Z", 1), (7, None, "", "", None)]
    return docs


def written(docs, tmp_path, spark, name):
    cases.frame(spark, docs).write.parquet(f"{tmp_path}/{name}/documents.parquet")
    return f"{tmp_path}/{name}"


@pytest.mark.parametrize("docs", [cases.rows(), many(), many()[:1]], ids=["odd", "sizes", "one"])
def test_query(spark, tmp_path, docs):
    got = [tuple(r) for r in queries.op13_merkle_manifest(spark, written(docs, tmp_path, spark, "in")).collect()]
    want = brute(docs)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    if len(docs) > 100:
        assert 0 < sum(not r[-1] for r in want) < len(want)


@pytest.mark.parametrize(("fan", "every", "per_task"), [(3, 1, 7), (2, 2, 50), (3, 2, 100_000), (4, 9, 3)])
def test_checkpoints_do_not_change_the_result(spark, fan, every, per_task):
    docs = many()
    df = cases.frame(spark, docs)
    leaf = merkle.leaf(df, ["doc_id", "source", "lang", "n_chars", "text"])
    made = merkle.manifest(df, Scratch(spark, "m"), "source", "doc_id", leaf, {"doc_id": F.col("doc_id")}, fan, every, per_task)
    groups = collections.defaultdict(list)
    for row in docs:
        groups[row[3]].append((row[0] is not None, row[0] or 0, brute_leaf(row, row[1])))
    tops = {s: brute_tree([x[2] for x in sorted(rows)], fan)[0] for s, rows in groups.items()}
    root = brute_tree([tops[s] for s in sorted(tops, key=lambda s: (s is not None, (s or "").encode()))], fan)[0]
    assert [r.root for r in made.root().collect()] == [root]
    assert {r.group if r.group else None: r.subroot for r in made.subroots().collect() if r.group} == {
        s: t for s, t in tops.items() if s
    }
    proofs = made.proofs().select("root", merkle.folded(F.col("leaf"), F.col("proof")).alias("folded")).collect()
    assert len(proofs) == len(docs) and all(r.root == r.folded == root for r in proofs)


def test_stored_levels_are_few(spark):
    docs = [(i, str(i), None, "a", i) for i in range(1000)]
    df = cases.frame(spark, docs, extra=False)
    leaf = merkle.leaf(df, ["doc_id", "text"])
    made = merkle.manifest(df, Scratch(spark, "m"), "source", "doc_id", leaf, {"doc_id": F.col("doc_id")}, every=3)
    assert [level.count() for level in made.groups.levels] == [1000, 38, 2, 1]


def test_empty(spark, tmp_path):
    got = queries.op13_merkle_manifest(spark, written([], tmp_path, spark, "none"))
    assert got.collect() == [] and got.columns[0] == "doc_id"


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]", "local-cluster[3,2,1024]", "spark://host:7077", "yarn"])
def test_a_cluster_needs_a_shared_folder(master):
    from llm.common import shared_dir

    kept = {}
    conf = type("Conf", (), {"get": lambda self, key, default: kept.get(key, default), "set": lambda self, key, value: kept.update({key: value})})()
    session = type("Session", (), {"conf": conf, "sparkContext": type("Context", (), {"master": master})()})()
    if master.startswith(("local[", "local")) and "cluster" not in master:
        assert shared_dir(session) == kept["spark.checkpoint.dir"]
    else:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session)
