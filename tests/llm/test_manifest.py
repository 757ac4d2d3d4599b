import hashlib
import random
import zlib

from pyspark.sql import functions as F

from tastegraph.llm import manifest
from tastegraph.llm.queries import op13_manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, source string, lang string, n_chars int, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes):
    """The last node, and for each node the siblings level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, place in enumerate(at):
            run = nodes[place - place % 8 : place - place % 8 + 8]
            paths[n].append((run[: place % 8], run[place % 8 + 1 :]))
        nodes = [h(*nodes[i : i + 8]) for i in range(0, len(nodes), 8)]
        at = [place // 8 for place in at]
    return nodes[0], paths


def brute(rows):
    """``(doc_id, leaf, subroot, root, proof, folded, verified)``."""
    groups = {}
    for row in rows:
        groups.setdefault((row[2] is not None, (row[2] or "").encode()), []).append(row)
    order, subroots, inner = sorted(groups), [], []
    for key in order:
        groups[key].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        subroot, paths = climb([leaf(r) for r in groups[key]])
        subroots.append(subroot)
        inner.append(paths)
    root, outer = climb(subroots)
    out = []
    for key, subroot, paths, upper in zip(order, subroots, inner, outer):
        for row, path in zip(groups[key], paths):
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            fold = leaf((*row[:4], row[4].translate(LOWER) if changed and row[4] else row[4]))
            for left, right in path + upper:
                fold = h(*left, fold, *right)
            proof = h(*[x for left, right in path + upper for x in left + right])
            out.append((row[0], leaf(row), subroot, root, proof, fold, fold == root))
    return sorted(out, key=repr)


def cases(sizes, seed=3):
    rng, rows, doc = random.Random(seed), [], 0
    for lang, size in sizes.items():
        for _ in range(size):
            doc += rng.randint(1, 3)
            text = rng.choice([None, "", "plain é", "With Capitals É", "x" * 3000, "same", "same"])
            rows.append((doc, rng.choice([None, "", "web"]), lang, rng.choice([None, 0, 7]), text))
    rng.shuffle(rows)
    return rows


def query(spark, tmp_path, rows, extra=""):
    frame = spark.createDataFrame([(*r, 1, "k") if extra else r for r in rows], SCHEMA + extra)
    frame.repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, op13_manifest(spark, str(tmp_path)).collect()), key=repr)


def test_groups_of_many_sizes(spark, tmp_path):
    rows = cases({None: 9, "": 1, "a": 8, "b": 64, "c": 65, "de": 7, "é": 700, "z": 2, "Z": 17, "~": 1})
    rows += [(None, "s", "b", 1, "no id"), (None, None, None, None, None), rows[0], rows[0], (rows[0][0], *rows[0][1:4], "other")]
    got = query(spark, tmp_path, rows, ", path int, `group` string")
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_one_group_of_several_blocks(spark, tmp_path):
    rows = cases({"en": manifest.BLOCK * 2 + 5, "fr": 3})
    assert query(spark, tmp_path, rows) == brute(rows)


def test_one_row_and_one_group(spark, tmp_path):
    for n, sizes in enumerate(({"en": 1}, {None: 20})):
        rows = cases(sizes)
        assert query(spark, tmp_path / str(n), rows) == brute(rows)


def test_proofs_fold_to_the_root(spark):
    docs = spark.createDataFrame(cases({"x": 30, "y": 4}), SCHEMA)
    found = manifest.manifest(docs).withColumn("folded", manifest.folded(F.col("leaf"), F.col("path")))
    assert found.count() == 34 and found.where(F.col("folded") != F.col("root")).isEmpty()


def test_empty_table(spark, tmp_path):
    assert query(spark, tmp_path, []) == []
