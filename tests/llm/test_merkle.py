"""Merkle manifest against a plain tree."""

import hashlib
import zlib

import pytest

from occuspark.llm import merkle

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, pos string, leaf int, _at int"


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        n = out[-1]
        out.append([H("".join(n[i:i + 2])) for i in range(0, len(n), 2)])
    return out


def leaf_of(r, more=0):
    doc_id, text, lang, source, n_chars = r[:5]
    values = [doc_id, source, lang, None if n_chars is None else n_chars + more, text]
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def walk(tree, i):
    """Siblings with the place of each, and a function that folds a leaf."""
    path = []
    for nodes in tree[:-1]:
        path.append((i & 1, nodes[i ^ 1] if i ^ 1 < len(nodes) else None))
        i >>= 1
    return path


def plain(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {g: sorted((r for r in rows if r[2] == g), key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
              for g in langs}
    trees = {g: levels([leaf_of(r) for r in groups[g]]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs])
    out = []
    for k, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            path = walk(trees[g], i) + walk(top, k)
            node = leaf_of(r, r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)
            for odd, other in path:
                node = H(node) if other is None else H(other + node) if odd else H(node + other)
            out.append((r[0], leaf_of(r), trees[g][-1][0], top[-1][0], H("".join(s for _, s in path if s)), node,
                        node == top[-1][0]))
    return out


def rows_of(n):
    rows = [(i, f"text {i}\n\u00e9", ["en", "de", None, "\u00e9s", "zz"][0 if i % 3 else i % 5], f"s{i % 4}", i, "x", 7, 1)
            for i in range(n)]
    return rows + [(3, None, "en", None, None, "x", None, None), (3, "", "en", None, None, None, None, None),
                   (None, "a", "en", "s", 4, None, None, None), (None, "a", "en", "s", 4, None, None, None),
                   (7, "w " * 60_000, "solo", "s", None, None, None, None), (2**60 + 1, "big", "en", "s", 9, None, None, None)]


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_manifest_equals_a_plain_tree(spark, bits):
    rows = rows_of(90)
    docs = spark.createDataFrame(rows, COLUMNS)
    made = merkle.verify(merkle.manifest(docs, merkle.id_hit(7), bits)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, made), key=key) == sorted(plain(rows), key=key)
    assert {r.verified for r in made} == {True, False}


def test_streaming_appends_extend_witnesses():
    for n in range(1, 40):
        nodes = [H(str(i)) for i in range(n)]
        tree, stream = levels(nodes), merkle.AppendStream()
        for i, d in enumerate(nodes):
            stream.append(d)
            assert [a for _, _, a, _ in stream.open][0] == 0 and len(stream.open) == bin(i + 1).count("1")
        assert stream.close() == tree[-1][0]
        for i, steps in enumerate(stream.steps()):
            want = [(2 if s is None else 1 - odd, s or "") for odd, s in walk(tree, i)]
            assert [(s["side"], s["digest"]) for s in steps] == want


def test_one_row_and_empty_table(spark):
    one = merkle.verify(merkle.manifest(spark.createDataFrame(rows_of(1)[:1], COLUMNS))).collect()
    assert one[0].leaf == one[0].root == one[0].subroot and one[0].proof_sha256 == H("") and one[0].verified
    assert merkle.verify(merkle.manifest(spark.createDataFrame([], COLUMNS))).collect() == []
