"""Every operator on small tables: nulls, empty tables, ties, repeated rows, columns of clashing names; and against brute force."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import chat, jaccard, langid, mixing, neighbours, packing, pii, token_counts, topk, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, cid string, n string, row string"
WORDS = "the quick brown fox jumps over a lazy dog while nine small birds sing about rain in spring and autumn leaves".split()


@pytest.fixture(scope="module")
def odd(spark):
    long_text = " ".join(WORDS[(i * 7) % len(WORDS)] + str(i % 97) for i in range(6000))
    texts = [(0, "Hello there, mail a.b@c.de now"), (1, "Hello there, mail a.b@c.de now"), (1, "Hello there, mail a.b@c.de now"),
             (2, None), (3, ""), (None, "no id here"), (4, " \n\t "), (5, "12 34 !!"), (6, long_text), (7, long_text + " end"), (8, "4111 1111 1111 1111")]
    return spark.createDataFrame([(i, t, None if i == 4 else "en", None if i == 5 else "s", len(t or ""), "x", "y", "z", "w") for i, t in texts], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_near_duplicates(odd, empty):
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.component_id, r.n_shingles > 0) for r in jaccard.near_duplicates(odd).collect())
    assert found == [(-1, None, True), (0, 0, True), (1, 0, True), (1, 0, True), (2, 2, False), (3, 3, False), (4, 4, False), (5, 5, True), (6, 6, True), (7, 6, True), (8, 8, True)]
    assert jaccard.near_duplicates(empty).count() == 0
    kept = jaccard.one_per_group(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, -1, 2, 3, 4, 5, 6, 8]


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = [list(rng.choice(WORDS, 60)) for _ in range(6)]
    rows = []
    for i in range(120):
        words = list(base[i % 6])
        for at in rng.integers(0, 60, rng.integers(0, 4)):
            words[at] = f"w{rng.integers(0, 50)}"
        rows.append((i, " ".join(words)))
    for n, num, den in ((3, 9, 10), (5, 4, 5)):
        sets = {i: {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} for i, w in ((i, t.split()) for i, t in rows)}
        root = {i: i for i in sets}

        def find(x):
            return x if root[x] == x else find(root[x])

        for i in sets:
            for j in range(i):
                both = len(sets[i] & sets[j])
                if den * both >= num * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
        found = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), n, num, den).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {i: (len(s), find(i)) for i, s in sets.items()}


VECTORS = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (50, [0.5, 0.5]), (100, None), (150, [1.0, None]), (200, [float("nan"), 1.0]),
           (None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, []), (5, [1.0])]


def test_vector_searches(spark):
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in VECTORS], "vec_id long, embedding array<float>, block string, id string")
    found = [(r.query_id, r.rank, r.vec_id, r.score) for r in topk.search(table, 3, 50, 1).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 50, 32768), (50, 1, 0, 32768), (50, 2, 1, 32768), (50, 3, 2, 32768)]
    near = [(r.query_id, r.vec_id, r.score) for r in neighbours.search(table, 20, 50).orderBy("query_id", "rank").collect()]
    assert near == [(0, 1, 1.0), (0, 2, 1.0), (0, 50, 0.5), (50, 0, 0.5), (50, 1, 0.5), (50, 2, 0.5)]
    none = table.limit(0)
    assert topk.search(none, 3, 50, 1).count() == 0 and neighbours.search(none, 3, 50).count() == 0


def test_vector_searches_against_brute_force(spark):
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(3000, 12)) * rng.exponential(size=(3000, 1))).astype(np.float32)
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    whole, exact = np.floor(256 * x.astype(float)), x.astype(float) @ x.T.astype(float)
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in topk.search(table, 5, 50, 4).collect()}
    for q in range(0, 3000, 50):
        s = whole @ whole[q]
        best = sorted((-int(s[i]), i) for i in range(3000) if i != q)[:5]
        assert [got[q, k + 1] for k in range(5)] == [(i, -v) for v, i in best]
    hits = {}
    for r in neighbours.search(table, 20, 20).collect():
        hits.setdefault(r.query_id, set()).add(r.vec_id)
    share = [len(hits[q] & set(sorted((i for i in range(3000) if i != q), key=lambda i: (-exact[q, i], i))[:20])) / 20 for q in range(0, 3000, 20)]
    assert np.mean(share) >= 0.9


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def luhn(d):
        return sum(int(c) * (1 + i % 2) - 9 * (int(c) * (1 + i % 2) > 9) for i, c in enumerate(reversed(d))) % 10 == 0

    digits = lambda m: re.sub("[^0-9]", "", m)
    good = {"email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
            "card": lambda m: 13 <= len(digits(m)) <= 19 and luhn(digits(m)), "phone": lambda m: 9 <= len(digits(m)) <= 15}
    return [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text) if good[k](m[0])]


def test_pii_spans_equal_plain_patterns(spark, odd, empty):
    rng = np.random.default_rng(8)
    texts = ["a.b-c@d.e_f@g.h.i@j.k", "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.000255", "4111-1111-1111-1111 5", "++1 234 567 890 1", "1" * 5000, "a" * 9000, "a@" + "b." * 2000 + "c"]
    texts += ["".join(rng.choice(list("a1.@+- 59()é🙂"), 60)) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.spans(rows).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(plain_spans(texts[r.doc_id])).encode()).hexdigest()
    assert pii.spans(odd).count() == odd.count() and pii.spans(empty).count() == 0
    masked = {r.doc_id: r for r in pii.masked(odd).collect()}
    assert masked[0].text == "Hello there, mail <EMAIL> now" and masked[0].n_chars == 29 and masked[2].text is None and masked[8].text == "<CARD>"


def test_secrets_are_found_by_votes(spark):
    rng = np.random.default_rng(4)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 40)) for _ in range(30)]
    rows = [(i, f'some words token = "{h}" and incomprehensibilities there') for i, h in enumerate(hexes)]
    rows += [(100 + i, "plain words internationalization uncharacteristically only") for i in range(100)]
    found = {r.doc_id: r.spans for r in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(found[i] == "secret:20:60" for i in range(30)) and not any(found[100 + i] for i in range(100))


def test_language_mixing_toxicity_on_odd_rows(spark, odd, empty):
    found = {r.doc_id: r for r in langid.identify(odd).collect()}
    assert found[0].lang_pred == "en" and all(found[i].lang_pred == "und" and found[i].score == 0 for i in (2, 3, 4, 5))
    assert langid.identify(empty).count() == 0
    labels = spark.createDataFrame([(0, 1), (None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.severity(odd, labels).count() == odd.count() and toxicity.severity(empty, labels.limit(0)).count() == 0
    sources, rows = mixing.copies(odd, mixing.Target(passes=1.5))
    assert rows.count() == odd.count() and rows.agg(F.min("__copies")).first()[0] >= 1
    assert mixing.mixture(odd, mixing.Target(passes=1.5)).columns == odd.columns
    assert mixing.mixture(empty, mixing.Target(passes=1.5)).count() == 0


def test_mixture_spends_its_budget(spark):
    rows = spark.range(20000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 3)).alias("source"), F.lit("word " * 8).alias("text"))
    sources, mixed = mixing.copies(rows, mixing.Target(passes=2.0))
    spent = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.col("__copies") * 10).alias("n")).collect()}
    for r in sources.collect():
        assert abs(spent[r.name] - r.quota) <= 10 and abs(r.quota / sum(spent.values()) - r.weight) < 0.01


def test_token_counts_and_packing(odd, empty):
    from tokenizers import Tokenizer

    path = packing.vocabulary("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = odd.filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).collect()
    found = {r.doc_id: r for r in token_counts.token_counts(odd, path).collect()}
    for r in rows:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (found[r.doc_id].n_tokens, found[r.doc_id].n_bytes, found[r.doc_id].over_limit) == (n, len((r.text or "").encode()), n > 2048)
    assert token_counts.token_counts(empty, path).count() == 0
    pieces = packing.pack(odd, packing.vocabulary("byte_bpe_50k.json")).collect()
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for s, own in sequences.items():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == list(np.cumsum([0] + [p.length for p in own])[:-1])
        assert sum(p.length for p in own) == own[0].sequence_length and (own[0].sequence_length == 1024 or s == max(sequences))
    assert packing.pack(empty, packing.vocabulary("byte_bpe_50k.json")).count() == 0


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "a\\b", "\\l\\\\b", "<|turn|>x<|end|>", "", None, "<<SYS>>", "|>|>", "[", "<<s>🙂"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)] + [(2, 0, None, "x"), (None, None, "us<|er", "y")]
    table = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, turns string")
    done = {r.conv_id: r for r in chat.read_back(chat.formatted(table)).collect()}
    assert [(t.role, t.text) for t in done[1].turns] == [(r, t or "") for _, _, r, t in rows[:10]]
    assert done[1].loss_text == "".join(t or "" for _, _, r, t in rows[:10] if r == "assistant")
    assert done[None].turns[0].role == "us<|er" and done[2].turns[0].role == ""
    assert chat.digests(table.limit(0)).count() == 0


def test_pipeline_keeps_what_it_should(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    kept = corpus_pipeline.language(spark, docs, data)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    once = corpus_pipeline.near_duplicates(spark, docs, data)
    assert once.count() == jaccard.near_duplicates(docs).select("component_id").distinct().count()
    pieces = corpus_pipeline.run(spark, data).collect()
    assert {p.doc_id for p in pieces} <= {r.doc_id for r in once.collect()}
    assert len({p.doc_id for p in pieces}) == once.count()


FOREIGN = [
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı hareket ederler.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
    "Semua orang dilahirkan merdeka dan mempunyai martabat dan hak-hak yang sama. Mereka dikaruniai akal dan hati nurani.",
]


def test_foreign_languages_and_noise_go(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rng = np.random.default_rng(7)
    noise = FOREIGN + ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 400)),
                       " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n)) for n in rng.integers(2, 10, 80)), "123 !?", None]
    more = spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(noise)], "doc_id long, text string")
    kept = corpus_pipeline.language(spark, docs.unionByName(more, allowMissingColumns=True), data)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_all_links_equal_brute_force(spark, odd, empty):
    rng = np.random.default_rng(6)
    base = [list(rng.choice(WORDS, 60)) for _ in range(3)]
    rows = []
    for i in range(400):  # the sets of a base are more than one block of a key
        words = list(base[0] if i < 320 else base[1 + i % 2])
        for at in rng.integers(0, 60, rng.integers(0, 3)):
            words[at] = f"w{rng.integers(0, 50)}"
        rows.append((i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: frozenset(tuple(w[j : j + 3]) for j in range(len(w) - 2)) for i, w in ((i, t.split()) for i, t in rows)}
    alike = lambda x, y: 10 * len(x & y) >= 9 * len(x | y)
    pairs, found = jaccard.similar_sets(table, 3, 9, 10)
    found = {r.doc_id: r for r in found.collect()}
    assert {i: r.n_links for i, r in found.items()} == {i: sum(alike(sets[i], sets[j]) for j in sets if j != i) for i in sets}
    ids = {i: r.cid for i, r in found.items()}
    wanted = {tuple(sorted((ids[i], ids[j]))) for i in sets for j in sets if ids[i] != ids[j] and alike(sets[i], sets[j])}
    pairs = [(r.a, r.b) for r in pairs.collect()]
    assert set(pairs) == wanted and len(pairs) == len(wanted)
    assert {(r.doc_id, r.component_id) for r in found.values()} == {(r.doc_id, r.component_id) for r in jaccard.near_duplicates(table, 3, 9, 10).collect()}
    links = sorted((-1 if r.doc_id is None else r.doc_id, r.n_links) for r in jaccard.similar_sets(odd)[1].collect())
    assert links == [(-1, 0), (0, 2), (1, 2), (1, 2), (2, 0), (3, 0), (4, 0), (5, 0), (6, 1), (7, 1), (8, 0)]
    assert jaccard.similar_sets(empty)[1].count() == 0


def test_registered_mixing_counts_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    from ledgerline.llm import queries

    path = packing.vocabulary("byte_bpe_50k.json")
    texts = {"english": "the people of this country are going to the house ", "other": "żółć 日本語 🙂 ñandú §¶ ", None: "x  y <|endoftext|> "}
    rows = [(i, texts[s] * (1 + i % 5), s) for i, s in enumerate([*["english"] * 60, *["other"] * 30, *[None] * 9])] + [(99, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    library = Tokenizer.from_file(path)
    tokens = {}
    for _, text, source in rows:
        tokens[source or ""] = tokens.get(source or "", 0) + max(1, len(library.encode(text or "", add_special_tokens=False).ids))
    sources, mixed = mixing.copies(table, mixing.Target(passes=1.25), path)
    assert {r.name: r.tokens for r in sources.collect()} == tokens
    names = sorted(tokens)
    counts = [float(tokens[n]) for n in names]
    weights = dict(zip(names, mixing.tempered(counts, mixing.bisected(counts, mixing.Target(passes=1.25)))))
    found = queries.QUERIES["op8_source_mixing"](spark, str(tmp_path)).collect()
    assert len(found) == len(rows) and all(abs(r.weight - weights[r.source or ""]) < 1e-9 and r.copies >= 1 for r in found)


def test_equal_vectors_tie_in_every_cell(spark, monkeypatch):
    from ledgerline.llm import vectors

    monkeypatch.setattr(vectors, "BLOCK_ROWS", 128)  # several cells
    rng = np.random.default_rng(9)
    same = rng.normal(size=13)
    same /= np.linalg.norm(same)
    x = [same if i % 2 else v / np.linalg.norm(v) for i, v in enumerate(rng.normal(size=(600, 13)))]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.search(table, 5, 20).collect():
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    queries = spark.createDataFrame([(1000, same.tolist())], table.schema)
    whole = {r.rank: r.vec_id for r in neighbours.search(table.unionAll(queries), 20, 1000).filter("query_id = 1000").collect()}
    assert [whole[k] for k in range(1, 21)] == list(range(1, 40, 2))
    for own in found.values():
        for k in range(1, 5):
            assert (-own[k][1], own[k][0]) < (-own[k + 1][1], own[k + 1][0])


def test_what_has_no_letter_is_undetermined(spark, odd):
    rows = spark.createDataFrame([(0, "\u2764\ufe0f"), (1, "1\ufe0f\u20e3 2"), (2, "\u0301"), (3, "e\u0301t\u00e9 mail"), (4, "12 a\u0308")], "doc_id long, text string")
    learned = langid.fit(odd)
    found = {r.doc_id: (r.lang_pred, r.score > 0) for r in langid.predict(rows, learned).collect()}
    assert [found[i][0] for i in range(3)] == ["und"] * 3 and not any(found[i][1] for i in range(3))
    assert found[3][0] != "und" and found[4][0] != "und"


def test_four_languages_by_plain_sets_and_held_out(spark):
    rng = np.random.default_rng(21)
    syllables = {"aa": "ka lo mi ru ten", "bb": "sch ung ein der ich", "cc": "eau oux ille ment que", "dd": "ción aba ños que ero"}
    said = lambda lang: " ".join("".join(rng.choice(syllables[lang].split(), rng.integers(1, 4))) for _ in range(40))
    rows = [(i, said(lang), lang) for i, lang in enumerate(sorted(syllables) * 60)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(table)
    grams = {}
    for i, text, lang in rows:
        if not __import__("zlib").crc32(str(i).encode()) % 5 == 0:
            grams.setdefault(lang, set()).update(langid.letter_grams([text])[0].tolist())
    right = 0
    found = langid.predict(table, model).collect()
    for r in found:
        own = langid.letter_grams([rows[r.doc_id][1]])[0].tolist()
        plain = {lang: sum(g in held for g in own) for lang, held in grams.items()}
        assert r.lang_pred == max(sorted(plain), key=plain.get)
        right += r.lang_pred == rows[r.doc_id][2] and r.held_out
    assert right == sum(r.held_out for r in found) > 20


def test_stages_keep_columns_of_any_name(spark, odd):
    clash = odd.select("doc_id", "text", "lang", "source", "n_chars", F.lit("a").alias("pii_text"), F.lit("b").alias("pii_secret"), F.lit("c").alias("__block"),
                       F.lit("d").alias("__lang"), F.lit("e").alias("__known"), F.lit("f").alias("row"), F.lit("g").alias("__name"), F.lit("h").alias("__copies"))
    for made in (pii.masked(clash), langid.kept(clash, langid.fit(clash)), mixing.mixture(clash, mixing.Target(passes=1.5)), jaccard.one_per_group(clash)):
        assert made.columns == clash.columns
        assert {tuple(r)[5:] for r in made.collect()} == {tuple("abcdefgh")}
        assert made.limit(0).count() == 0
    assert not any("@" in (r.text or "") for r in pii.masked(clash).collect())


def test_an_unlabelled_table_keeps_its_rows(spark, odd, data):
    bare = odd.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, bare, data)
    assert kept.columns == bare.columns and kept.count() == bare.count()
    assert corpus_pipeline.language(spark, bare.limit(0), data).count() == 0


def test_settings_and_overlaps_are_masked_whole(spark):
    token = "a1b2c3d4e5fx" + "4111111111111111" + "xa1b2c3d4e5f"  # a card number within a secret
    rows = [(0, "password = hunter2 and more"), (1, f"here is {token} end"), (2, "token: the next word"), (3, 'pwd: "Tr0ub4dor&3"'), (4, None), (5, ""), (6, "mail a@b.cd, a@b.cd")]
    rows += [(10 + i, f'secret = "{"0123456789abcdef" * 2}{i}"') for i in range(20)] + [(40 + i, "auth: yes or token: none") for i in range(20)]
    found = {r.doc_id: r.text for r in pii.masked(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[0] == "password = <SETTING> and more" and found[1] == "here is <SECRET> end" and found[3] == 'pwd: "<SETTING>"'
    assert found[2] == rows[2][1] and found[4] is None and found[5] == "" and found[6] == "mail <EMAIL>, <EMAIL>" and found[45] == "auth: yes or token: none"
    spans = {r.doc_id: r.spans for r in pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert spans[0] == "setting:11:18" and spans[1] == "card:20:36" and spans[2] == ""


def test_pieces_equal_the_tokenizers_ids(odd):
    import zlib

    from tokenizers import Tokenizer

    path = packing.vocabulary("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    ids = {}
    for r in odd.filter("doc_id IS NOT NULL").collect():
        ids[r.doc_id] = np.array([*library.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
    pieces = [p for p in packing.pack(odd, path).collect() if p.doc_id is not None]
    copies = {r.doc_id: r["count"] for r in odd.groupBy("doc_id").count().collect()}
    for doc, own in ids.items():
        found = sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces if p.doc_id == doc)
        assert sum(n for _, n, _, _ in found) == copies[doc] * len(own)
        for start, n, crc, total in found:
            assert total == len(own) and crc == zlib.crc32(own[start : start + n].tobytes())
        covered = np.zeros(len(own), int)
        for start, n, _, _ in found:
            covered[start : start + n] += 1
        assert (covered == copies[doc]).all()


def test_copies_follow_from_sorted_places(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("low").alias("source"),
                                    F.concat(F.lit("word "), F.repeat(F.lit("more "), (F.col("id") % 7).cast("int"))).alias("text"))
    sources, mixed = mixing.copies(rows, mixing.Target(passes=1.6))
    found = mixed.withColumn("n", mixing.estimated_tokens(F.col("text"))).collect()
    for s in sources.collect():
        own = sorted((r["__place"], r.n, r["__copies"]) for r in found if r.source == s.name)
        full, left = divmod(s.quota, sum(n for _, n, _ in own))
        run = 0
        for place, n, copies in own:  # places are distinct here
            run += n
            assert copies == full + (run <= left), (s.name, place)
        assert len({p for p, _, _ in own}) == len(own)


def test_attachments_become_placeholders(spark):
    kind = f"conv_id long, turn long, role string, parts array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>"
    text = lambda t: ("text", t, None, None, None, None, None)
    rows = [(1, 0, "user", [text("look <|end|> "), ("image", None, "a.png", 28, 15, None, None), text(" and "), ("audio", None, "b.wav", None, None, 1.5, None)]),
            (1, 1, "assistant", [("document", None, "c.pdf", None, None, None, 3), text("done \\ |>")]), (2, 0, "user", [("image", None, None, None, None, None, None), ("video", "?", "x", None, None, None, None)]),
            (3, 0, "user", [])]
    done = chat.formatted(spark.createDataFrame(rows, kind), F.col("parts"))
    found = {r.conv_id: r for r in done.collect()}
    assert found[1].formatted == ("<|turn|>user<|body|>look \\l|end\\p> <|image:0|> and <|audio:1|><|end|>"
                                  "<|turn|>assistant<|body|><|document:0|>done \\\\ \\p><|end|>")
    assert [(a.turn, a.n, a.type, a.ref, a.tokens) for a in found[1].attachments] == [(0, 0, "image", "a.png", 4), (0, 1, "audio", "b.wav", 38), (1, 0, "document", "c.pdf", 768)]
    assert found[1].attachment_tokens == 810 and found[2].attachment_tokens == 0 and [a.type for a in found[2].attachments] == ["image"]
    back = {r.conv_id: r for r in chat.read_back(done).collect()}
    assert [t.text for t in back[1].turns] == ["look <|end|> <|image:0|> and <|audio:1|>", "<|document:0|>done \\ |>"] and back[1].loss_text == "<|document:0|>done \\ |>"
    assert back[2].turns[0].text == "<|image:0|>?" and back[3].turns[0].text == ""


def test_pipeline_on_planted_cases(spark, data, tmp_path):
    """One planted case a stage: noise goes, a near copy goes, an address is masked, sources repeat, pieces hold the masked ids."""
    import zlib

    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{data}/documents.parquet")
    known = docs.filter("lang = 'en'").orderBy("doc_id").limit(60)
    base = known.filter(F.length("text") > 1500).orderBy("doc_id").first()
    words = base.text.split(" ")
    words[3], words[-4] = "changed", "otherwise"
    top = 10**9
    said = base.text[200:900]
    more = [(top, "xq zvvk wq kkz pqx jjw zzq vkx qpz " * 20, None, "noise", 0), (top + 1, " ".join(words), "en", "copy", 0), (top + 2, f"{said} reach me at jane.roe@example.org soon", "en", "mail", 5)]
    table = known.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long").select(*[F.col(c).cast(known.schema[c].dataType) for c in known.columns]))
    table.write.parquet(f"{tmp_path}/documents.parquet")
    found = {}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, str(tmp_path)), name)
        found[name] = docs
    ids = lambda name: {r.doc_id for r in found[name].select("doc_id").collect()}
    assert top not in ids("language_id") and {top + 1, top + 2} <= ids("language_id")
    assert top + 1 not in ids("ngram_jaccard_join") and {base.doc_id, top + 2} <= ids("ngram_jaccard_join")
    masked = found["pii"].filter(F.col("doc_id") == top + 2).first()
    assert masked.text == f"{said} reach me at <EMAIL> soon" and masked.n_chars == len(masked.text)
    assert ids("source_mixing") == ids("pii") == ids("ngram_jaccard_join") and found["source_mixing"].count() >= found["pii"].count()
    library = Tokenizer.from_file(packing.vocabulary("byte_bpe_50k.json"))
    own = np.array([*library.encode(masked.text, add_special_tokens=False).ids, 0], "<u4")
    pieces = [p for p in corpus_pipeline.run(spark, str(tmp_path)).filter(F.col("doc_id") == top + 2).collect()]
    assert pieces and all(p.ids_crc32 == zlib.crc32(own[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(own) for p in pieces)


def test_queries_of_a_block_share_their_work():
    import time

    rng = np.random.default_rng(31)
    x = rng.normal(size=(4096, 64))
    x[::5] = x[0]
    most, project = float((x * x).sum(1).max()), rng.normal(size=(65, 16))
    points = np.concatenate([x, np.sqrt(np.maximum(most - (x * x).sum(1), 0))[:, None]], 1) @ project
    order, _ = neighbours.kd_order(points)
    ids = np.arange(4096)[order]
    queries = np.arange(0, 4096, 16)

    def found(asked):
        q, v, s = neighbours.search_block(asked, x[asked], ids, x[order], points[order], project, most, neighbours.chi_square_quantile(0.98, 16), 20)
        return sorted(zip(q.tolist(), (-s).tolist(), v.tolist()))

    began = time.thread_time()
    together = found(queries)
    between = time.thread_time()
    alone = [r for q in queries for r in found(np.array([q]))]
    assert together == alone
    assert between - began < 0.6 * (time.thread_time() - between)
    exact = [(int(q), -float(s), int(v)) for q in queries for s, v in sorted((((x[v] * x[q]).sum(), v) for v in range(4096) if v != q), key=lambda r: (-r[0], r[1]))[:20]]
    assert len(set(together) & set(exact)) >= 0.9 * len(exact)
    assert {r for r in exact if r[0] % 80 == 0} <= set(together)  # copies of one vector: by smallest id


def test_pieces_are_counted_by_the_column():
    import time
    from collections import Counter

    import pyarrow as pa

    rng = np.random.default_rng(33)
    words = np.array(["".join(w) for w in rng.choice(list("abcdefgh\u00e9\n"), size=(60000, 6))])
    texts = [" ".join(words[rng.zipf(1.2, 400) % 60000]) for _ in range(4000)] + [None, "", " ", "a  b", "x" * 65, "\u00e9" * 64]
    stream = [pa.record_batch([pa.array(texts[i : i + 1000], pa.string())], names=["text"]) for i in range(0, len(texts), 1000)]
    began = time.thread_time()
    found = pa.Table.from_batches(list(token_counts._counted(iter(stream)))).to_pydict()
    between = time.thread_time()
    plain = Counter()
    for text in texts:
        plain.update((text or "").split(" "))
    took = time.thread_time() - between
    assert {p: n for p, n in plain.items() if len(p) <= 64} == dict(zip(found["piece"], found["n"])) and "\u00e9" * 64 in found["piece"]
    assert between - began < 1.2 * took
