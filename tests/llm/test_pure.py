"""Parts without Spark: hashing, prefixes, curves, tokens, models."""

import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from ledgerline.llm import jaccard, langid, mixing, neighbours, packing, pii, toxicity
from ledgerline.llm.shingles import shingle_sets


def test_shingles_follow_words_and_case():
    a, b, c, d, e = shingle_sets(pa.array(["The cat  sat\ton", "the CAT sat on", "the cat", "", None]), 3)
    assert len(a) == 2 and (a == b).all() and len(c) == 1 and not len(d) and not len(e)
    assert len(shingle_sets(pa.array(["x x x x x"]), 3)[0]) == 1


def test_similar_sets_share_a_key():
    """Two sets over the threshold have a prefix shingle in common, enough of longer prefixes, and a combination."""
    rng = np.random.default_rng(3)
    for num, den in ((9, 10), (4, 5), (1, 2)):
        for trial in range(300):
            n = int(rng.integers(1, 700 if trial % 2 else 30))
            x = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            changed = int(rng.integers(0, len(x) * (den - num) // den + 1))
            y = np.unique(np.concatenate([x[changed:], rng.integers(0, 1 << 63, int(rng.integers(0, 3))).astype(np.uint64)]))
            both = len(np.intersect1d(x, y))
            if not len(y) or den * both < num * (len(x) + len(y) - both):
                continue
            assert len(np.intersect1d(*[jaccard.combination_keys(s, num, den) for s in (x, y)]))
            for halves in (0, 1, 6):
                p, q = (jaccard.prefix(s, num, den, halves) for s in (x, y))
                least = min(min(1 + halves * jaccard.missing(-(-num * len(s) // den), num, den) // 2, len(s) - jaccard.missing(len(s), num, den)) for s in (x, y))
                assert len(np.intersect1d(p, q)) >= least


def test_shared_sizes():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (1, 5, 100, 200, 200)]
    found = jaccard.shared_sizes(sets, columns=7)
    assert all(found[i, j] == len(np.intersect1d(a, b)) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j)


def test_hilbert_curve_visits_neighbours():
    cells = np.array([(i, j) for i in range(16) for j in range(16)])
    keys = packing.hilbert_key(cells, 4)
    assert sorted(keys) == list(range(256))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def test_ids_are_the_tokenizers():
    path = packing.vocabulary("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), packing.Ids(path)
    rng = random.Random(1)
    texts = ["", " ", "a", " a", "a ", "a  b", "\n a", "it's  I'll", "<|endoftext|> x", "日本 語🙂 🙂", "é́ x", "\x1c a", "x" * 3000]
    texts += ["".join(rng.choice(" ab\n.,'é0🙂 ") for _ in range(40)) for _ in range(300)]
    for text, ids in zip(texts, own.of(texts)):
        assert np.frombuffer(ids, own.width).tolist() == library.encode(text, add_special_tokens=False).ids


def test_chi_square_quantile():
    assert abs(neighbours.chi_square_quantile(0.95, 2) - 5.9915) < 1e-3
    assert abs(neighbours.chi_square_quantile(0.9, 16) - 23.542) < 1e-2


def test_filters_answer_with_all_languages():
    filters = langid.build(["de", "en"], [(0, 5), (1, 5), (1, 9)])
    masks = filters.masks(np.array([5, 9, 1234567], np.int64).view(np.uint64))[:, 0].tolist()
    assert masks == [3, 2, 0]
    grams, text, has = langid.letter_grams(["Ab c", None, "12 !", ""])
    assert has.tolist() == [True, False, False, False] and set(text) == {0}


def test_exponent_meets_its_target():
    tokens = [1000.0, 100.0, 10.0]
    for target in (mixing.Target(passes=3.0), mixing.Target(entropy=0.9)):
        weights = mixing.tempered(tokens, mixing.bisected(tokens, target))
        got = mixing.most_passes(tokens, weights) if target.passes else -sum(w * np.log(w) for w in weights)
        assert abs(got - (target.passes or target.entropy)) < 1e-6
    assert mixing.bisected([5.0], mixing.Target(passes=2.0)) == 0.0


def test_em_finds_the_reliable_labelers():
    post, prior = pii.em({"11-": 40, "00-": 400, "1-0": 5, "0--": 100})
    assert post["11-"] > 0.9 and post["00-"] < 0.1 and prior < 0.3
    assert pii.em({})[0] == {} and pii.classifier([]) == {}


def test_ordinal_model_orders_grades():
    rng = np.random.default_rng(0)
    examples = [(0, np.unique(rng.integers(0, 500, 40))) for _ in range(200)]
    examples += [(1, np.unique(np.concatenate([rng.integers(0, 500, 40), 1000 + rng.integers(0, 20, k)]))) for k in (2, 5, 15) for _ in range(40)]
    model = toxicity.train(examples)
    assert (np.diff(model.thresholds) > 0).all()
    score = model.scores(np.zeros(12, int), np.arange(1000, 1012), 1)
    assert model.above(score).sum() > 1.5 and model.above(np.zeros(1))[0, 0] < 0.5
    assert toxicity.train([(0, np.array([1]))]).above(np.zeros(1)).sum() < 1e-9
