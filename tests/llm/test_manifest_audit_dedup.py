"""The manifest, the filter audit and suffix dedup against brute force, and on odd rows."""

import hashlib
import zlib
from collections import Counter
from itertools import permutations

import numpy as np
import pytest

from ledgerline.llm import filter_audit, merkle, suffixes

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, hash string, a string, place string"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(5, "Abc", "en", "s", 3), (1, None, None, None, None), (1, None, None, None, None), (2, "", "en", "", 0), (None, "Ünique", "de", "s", 6),
            (None, "Ünique", "de", "s", 6), (7, "ALL CAPS $", "en", "t", None), (3, "abc", "fr", "t", 3), (9, "ALL CAPS $", "en", "t", 10), (10, "x" * 900, "en", "s", 1)]
    return spark.createDataFrame([(*r, "1", "2", "3", "4") for r in rows], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_manifest(rows):
    """Per row (doc_id, leaf): subroot, root, proof, folded root, by plain lists."""
    def value(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(map(value, (r.doc_id, r.source, r.lang, r.n_chars, text))))

    def up(level):
        """Digests of the root's way: for every leaf its proof, as (left, right) lists."""
        proofs, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for i, a in enumerate(at):
                run = a - a % 16
                proofs[i].append((level[run:a], level[a + 1 : run + 16]))
            level, at = [sha("".join(level[i : i + 16])) for i in range(0, len(level), 16)], [a // 16 for a in at]
        return level[0], proofs

    sources = {}
    for r in rows:
        sources.setdefault(r.source, []).append((r.doc_id if r.doc_id is not None else -1, leaf(r, r.text), r))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: up([x[1] for x in sorted(sources[s], key=lambda x: x[:2])]) for s in names}
    root, tops = up([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, tops):
        for (_, own, r), low in zip(sorted(sources[s], key=lambda x: x[:2]), trees[s][1]):
            tampered = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0
            lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text) if r.text is not None else None
            now = leaf(r, lowered) if tampered else own
            for left, right in low + top:
                now = sha("".join([*left, now, *right]))
            proof = sha("".join(x for left, right in low + top for x in left + right))
            out.append((r.doc_id, own, trees[s][0], root, proof, now, now == root))
    return sorted(out, key=str)


def test_manifest_equals_plain_lists(spark, odd):
    assert sorted(map(tuple, merkle.audited(odd).collect()), key=str) == plain_manifest(odd.collect())
    assert merkle.audited(odd.limit(0)).count() == 0
    for n in (1, 16, 17, 273, 4097):  # full and broken runs, and more leaves than one pass takes
        many = spark.range(n).selectExpr("id * 3 AS doc_id", "concat('Text ', id) AS text", "'en' AS lang", "CASE WHEN id % 50 = 1 THEN concat('s', id) ELSE 'hot' END AS source", "id AS n_chars")
        assert sorted(map(tuple, merkle.audited(many).collect()), key=str) == plain_manifest(many.collect())


def test_tampering_is_found_where_it_changes_something(spark):
    many = spark.range(400).selectExpr("id AS doc_id", "CASE WHEN id % 2 = 0 THEN 'Upper' ELSE 'lower' END AS text", "'en' AS lang", "'s' AS source", "5L AS n_chars")
    found = {r.doc_id: r.verified for r in merkle.audited(many).collect()}
    assert found == {i: not (i % 2 == 0 and zlib.crc32(str(i).encode()) % 5 == 0) for i in range(400)} and not all(found.values())


def fails(text, doc_id, texts):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": doc_id is not None and any(t == text and d is not None and d < doc_id for d, t in texts)}


def plain_audit(rows, labels):
    texts = [(r.doc_id, r.text or "") for r in rows]
    good = {x[0] for x in labels if x[1] == 1 and x[0] is not None}
    toxic = {x[0] for x in labels if x[2] == 1 and x[0] is not None}
    marked = [(r.lang or "", fails(r.text or "", r.doc_id, texts), r.doc_id in good, r.doc_id in toxic) for r in rows]
    out = {}
    for part in {m[0] for m in marked}:
        own = [m[1:] for m in marked if m[0] == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                shapley[f] += len(gone)
                out[part, order, step] = [f, len(left), len(gone), sum(m[0][f] for m in own) - len(gone), sum(m[0][f] and sum(m[0].values()) == 1 for m in own),
                                          sum(m[1] for m in gone), sum(m[2] for m in gone)]
        for (p, _, _), row in out.items():
            if p == part:
                row.append(shapley[row[0]])
    return out


def test_filter_audit_equals_plain_filters(spark, odd):
    rng = np.random.default_rng(3)
    labels = [(5, 1, 0), (5, 0, 1), (7, None, 1), (None, 1, 1), (99, 1, 1), (9, 1, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    pool = [" ".join(rng.choice([f"w{i}" for i in range(400)], n)) + end for n in (20, 210, 300) for end in ("", " #", " ABCDEFGHIJKLMNOPQRSTUVWXYZABCDEFGHIJKLMNOPQRSTUVWXYZ")] + ["a b " * 150]
    more = [(int(i), pool[rng.integers(len(pool))], ["en", "de", None][i % 3]) for i in rng.integers(0, 60, 90)]
    for rows in (odd, spark.createDataFrame(more, "doc_id long, text string, lang string")):
        found = {(r.part, r.filter_order, r.step): list(r)[3:] for r in filter_audit.audit(rows, table).collect()}
        assert found == plain_audit(rows.collect(), labels)
    assert filter_audit.audit(odd.limit(0), table).count() == 0


def plain_dedup(texts, length=suffixes.LENGTH):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone])) == 1).sum()), hashlib.sha256(bytes(np.frombuffer(t, np.uint8)[~gone])).hexdigest()))
    return out


def planted(rng):
    """Passages in other surroundings, near and exact copies, periodic texts, and strings that only just repeat or don't."""
    word = lambda n: " ".join("".join(rng.choice(list("abcdefgé"), 5)) for _ in range(n))
    passage, base = word(80), word(300)
    texts = [word(30) + passage[: rng.integers(150, 480)] + word(20) for _ in range(12)] + [passage[rng.integers(0, 200) :] + word(10) for _ in range(6)]
    for _ in range(8):
        cut = list(base)
        for at in rng.integers(0, len(base), 3):
            cut[at] = "#"
        texts.append("".join(cut))
    exact = word(90)
    return texts + [base, exact, exact, "a" * 700, "abc" * 150, "x" * 199, "x" * 200, word(40) + "y" * 201, ("0123456789" * 30) + word(9), "", word(60) * 2, "é" * 150]


def test_suffix_dedup_equals_brute_force(spark, monkeypatch):
    texts = planted(np.random.default_rng(11))
    want = dict(enumerate(plain_dedup([t.encode() for t in texts])))
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, seed string").repartition(6)
    for parts, crowd in ((1, 4096), (3, 4096), (4, 2)):  # with crowd 2 most seeds with different runs go by window
        got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.deduped(rows, parts, crowd).collect()}
        assert got == want


def test_runs_in_pieces(monkeypatch):
    texts = [t.encode() for t in planted(np.random.default_rng(12))]
    flat, bounds = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    for piece in (1 << 19, 500):
        monkeypatch.setattr(suffixes, "_PIECE", piece)
        covered = Counter()
        for text, start, windows, *_ in suffixes.runs(flat, bounds):
            for t, s, w in zip(text, start, windows):
                covered.update((int(t), int(s + i)) for i in range(w))
        assert covered == Counter((t, i) for t, x in enumerate(texts) for i in range(len(x) - suffixes.LENGTH + 1))


def test_levels_merge_geometrically(spark):
    index = suffixes.SuffixIndex(spark)
    entry = "a long, b long, start long, windows long, seed long, run long, again boolean"
    sizes, found = [], []
    for i in range(5):
        rows = [(i, 0, 0, 1, 100 + i, 1, False), (i, 0, 9, 1, 7, i // 4, False), (i, 0, 20, 1, 50, i, i == 2)]
        found.append(sorted(map(tuple, index.add(spark.createDataFrame(rows, entry)).collect())))
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]
    assert found[0] == [] and found[1] == [(7, False), (50, True)] and found[2] == [(7, False), (50, True), (50, True)] and (7, True) in found[4]
    assert spark.sql(f"SHOW TABLES IN {index.name}").count() == 2


def test_suffix_dedup_on_odd_rows(spark, odd):
    found = sorted(((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_removed, r.n_spans) for r in suffixes.deduped(odd).collect()))
    assert found == [(-1, 7, 0, 0), (-1, 7, 0, 0), (1, 0, 0, 0), (1, 0, 0, 0), (2, 0, 0, 0), (3, 3, 0, 0), (5, 3, 0, 0), (7, 10, 0, 0), (9, 10, 0, 0), (10, 900, 900, 1)]
    assert suffixes.deduped(odd.limit(0)).count() == 0
    twice = odd.filter("doc_id IS NULL").unionAll(odd.filter("doc_id IS NULL")).selectExpr("doc_id", "repeat(text, 40) AS text")
    assert {(r.n_removed, r.n_spans) for r in suffixes.deduped(twice).collect()} == {(280, 1)}
