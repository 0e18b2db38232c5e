import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from stratiform.llm import queries
from stratiform.llm.merkle import MerkleRules, bitmap_ranks, fold_proofs, manifest, rank_texts, ranks

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
LOW = MerkleRules(depth=1)


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def up(nodes, proofs):
    """One tree: its root, and for each leaf its siblings appended to proofs[leaf] and (place, run) to the steps."""
    at = list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 3] for k in range(0, len(nodes), 3)]
        for k, spot in enumerate(at):
            proofs[k].append((spot % 3, runs[spot // 3]))
        at, nodes = [spot // 3 for spot in at], [h(*r) for r in runs]
    return nodes[0]


def brute(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, told = [], []
    for name in names:
        held = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        proofs = [[] for _ in held]
        subroots.append(up([leaf(r) for r in held], proofs))
        told.append((held, proofs))
    tops = [[] for _ in names]
    root = up(subroots, tops) if names else None
    out = []
    for k, (held, proofs) in enumerate(told):
        for row, proof in zip(held, proofs, strict=True):
            way = proof + tops[k]
            node = leaf(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                node = leaf((*row[:4], row[4] and row[4].replace("\n", "")))
            for place, run in way:
                node = h(*run[:place], node, *run[place + 1 :])
            siblings = "".join(x for place, run in way for x in run[:place] + run[place + 1 :])
            out.append((row[0], leaf(row), subroots[k], root, h(siblings), node, node == root))
    return sorted(out, key=str)


def got(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect()), key=str)


def some(n, seed, sources=(None, "", "a", "a\0", "b", "é", "zz long name", "zz long names")):
    rng = random.Random(seed)
    ids = rng.sample(range(-(2**40), 2**40, 2**33), 90) + rng.sample(range(3000), n - 90)
    return [(i, rng.choice(["a", rng.choice(sources)]), rng.choice(["x", None]), rng.choice([None, 5]), rng.choice([None, "", "x\ny\n", "é", f"t{i}"])) for i in ids]


def run(spark, tmp_path, rows):
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.op13_bitmap_rank_manifest(spark, str(tmp_path))


def test_against_plain_trees(spark, tmp_path):
    rows = some(800, 1)
    rows += [(None, "a", None, None, "n"), (None, "a", None, None, None), (7, "b", "x", 1, "r"), (7, "b", "x", 2, "r"), (7, "b", "x", 2, "r")]
    rows += [(50_000, "hot", "x", 3, f"{k % 40}\n") for k in range(200)]  # one id, copies among its rows
    assert got(run(spark, tmp_path, rows)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(2, "a", "b", 3, "x\n")] * 3])
def test_small_tables(spark, tmp_path, rows):
    assert got(run(spark, tmp_path, rows)) == brute(rows)


def test_rounds_of_blocks_and_other_leaves(spark, frame):
    rows = some(300, 2)
    docs = frame(rows, SCHEMA).withColumn("rank", F.lit(1)).withColumn("tree", F.lit("x"))
    made = manifest(docs, LOW, changed={"lang": F.lit("other")}).cache()
    assert {(r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), h(r.proof.hex())) for r in made.collect()} == {x[:5] for x in brute(rows)}
    assert fold_proofs(made, F.col("leaf")).where("folded_root <> root").count() == 0
    assert fold_proofs(made, F.col("changed_leaf")).where("folded_root = root").count() == 0


def test_ranks_in_bitmaps(spark, frame):
    rng = random.Random(4)
    rows = [(rng.choice(["a", None]), rng.choice([None, rng.randrange(300), rng.randrange(-(2**63), 2**63)]), k) for k in range(600)]
    table = frame(rows, "g string, id long, k long")
    got, repeats = bitmap_ranks(table, ["g"], "id")
    key = lambda x: (x is not None, x or 0)
    for r in got.collect():
        same = [x for x in rows if x[0] == r.g]
        assert r["rank"] == sum(key(x[1]) < key(r.id) for x in same) and r.same == sum(x[1] == r.id for x in same)
    assert repeats and not bitmap_ranks(table.where("id > 1000").dropDuplicates(["id"]), ["g"], "id")[1]
    places = [(r.g, r["rank"]) for r in ranks(table, ["g"], ["id", "k"]).collect()]
    assert len(set(places)) == 600 and max(p for g, p in places if g) == sum(r[0] is not None for r in rows) - 1


def test_texts_rank_by_bytes(frame):
    texts = [None, "", "a", "a\0", "aa", "b" * 7, "b" * 7 + "\0", "b" * 8, "b" * 20 + "x", "b" * 20 + "y", "é", "z", "\U0001f600"]
    got = {r.t: r["rank"] for r in rank_texts(frame([(t,) for t in texts], "t string"), "t").collect()}
    assert [got[t] for t in sorted(texts, key=lambda s: (s is not None, (s or "").encode()))] == list(range(len(texts)))
