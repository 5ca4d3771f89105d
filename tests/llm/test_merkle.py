import hashlib
import zlib

import pytest

from weekcast.llm import merkle as m


def H(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves, arity):
    """All levels and, for each leaf, the (left, right) siblings of each level."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([H("".join(levels[-1][i:i + arity])) for i in range(0, len(levels[-1]), arity)])
    ways = []
    for i in range(len(leaves)):
        way = []
        for nodes in levels[:-1]:
            a = i // arity * arity
            way.append(("".join(nodes[a:i]), "".join(nodes[i + 1:a + arity])))
            i //= arity
        ways.append(way)
    return levels[-1][0], ways


def plain(rows, arity):
    """The whole result by loops: rows are (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        found = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = (found, *plain_tree([leaf(r) for r in found], arity))
    root, tops = plain_tree([trees[g][1] for g in order], arity)
    out = []
    for g, above in zip(order, tops, strict=True):
        found, sub, ways = trees[g]
        for r, way in zip(found, ways, strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]) if tampered else r[4]
            node = leaf((*r[:4], text))
            for left, right in way + above:
                node = H(left + node + right)
            out.append((r[0], leaf(r), sub, root, H("".join(a + b for a, b in way + above)), node, node == root))
    return sorted(out, key=repr)


def run(spark, df, tmp, arity=16, every=2):
    leaves = m.document_leaves(df)
    made = m.proofs(m.build(leaves, f"{tmp}/g", ("_claim",), arity, every), f"{tmp}/r", "_claim", with_paths=True)
    rows = made.collect()
    for r in rows:  # the siblings themselves lead from the leaf to the root
        assert m.folded(r["leaf"], r["path"]) == r["root"]
    return sorted(((r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in rows), key=repr)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")


@pytest.mark.parametrize(("arity", "every"), [(2, 1), (2, 3), (3, 2), (16, 2)])
def test_against_loops(spark, tmp_path, arity, every):
    rows = [(i, f"s{i % 7 % 4 if i % 3 else 0}", "en", i, f"Text {i} Ä") for i in range(61)] + [(900, None, None, None, None), (901, "lone", "x", 0, "")]
    rows += [(1000 + i, f"many{i}", "en", 1, "A") for i in range(20)]
    assert run(spark, table(spark, rows).repartition(5), tmp_path, arity, every) == plain(rows, arity)


def test_edges(spark, make_docs, edge_rows, tmp_path):
    df = make_docs(edge_rows + [(None, None, None), (5, "x", "b")], clashing=True).selectExpr("*", "cast(length(text) as long) as n_chars")
    rows = [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]
    assert run(spark, df, tmp_path) == plain(rows, 16)


def test_equal_rows_are_leaves_of_their_own(spark, tmp_path):
    rows = [(7, "s", "en", 1, "Same")] * 300 + [(None, "s", "en", 1, None)] * 5
    assert run(spark, table(spark, rows).repartition(4), tmp_path) == plain(rows, 16)


def test_empty_and_lone(spark, tmp_path):
    assert run(spark, table(spark, []), tmp_path / "a") == []
    rows = [(3, "s", "en", 2, "Ab")]
    got = run(spark, table(spark, rows), tmp_path / "b")
    assert got == plain(rows, 16) and got[0][2] == got[0][3] == got[0][1] and got[0][4] == H("")


def test_only_every_second_level_is_written(spark, tmp_path):
    rows = [(i, "s", "en", 1, str(i)) for i in range(700)]
    made = m.build(m.document_leaves(table(spark, rows)), str(tmp_path / "g"), ("_claim",), 4, 2)
    assert [x.selectExpr("sum(size(_nodes))").first()[0] for x in made.levels] == [700, 44, 3]  # levels 0, 2 and 4 of 0 to 5


def test_bad_parameters(spark, tmp_path):
    with pytest.raises(ValueError):
        m.build(m.document_leaves(table(spark, [])), str(tmp_path), arity=1)
