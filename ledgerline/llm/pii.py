"""Personal data in texts, in DataFrame expressions only: fixed patterns, and weakly supervised spans beyond them.

Patterns give the base spans. Beyond these, labelers (regular expressions, gazetteers, context words) vote on candidate spans; expectation
maximisation over the counts of vote patterns estimates how reliable each labeler is, and its posteriors train a
logistic classifier of spans over votes and shape. What is fitted are tables of distinct patterns, some hundred rows whatever the
corpus; votes are counted over all documents.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.store import written

# Each pattern is the plain one, written so that Java's matcher takes linear time and no stack: a match can only begin
# where a run begins or the last match ended, and repetitions give nothing back, as nothing after them could use it.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){12,}+"  # shorter runs of digits cannot pass
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = ["email", "ip", "card", "phone"]

#: Beginnings of issued credentials, names of settings that hold them, numbers that are never issued: fixed values.
ISSUED = ["AKIA", "ASIA", "ghp_", "gho_", "github_pat_", "glpat-", "sk_live_", "xoxb-", "xoxp-", "AIza", "ya29"]
SETTINGS = ["password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "auth"]
NEVER_ISSUED = ["078-05-1120", "219-09-9999", "123-45-6789"]
NUMBER_WORDS = ["ssn", "social security", "tax id", "taxpayer"]

SPAN = "array<struct<begin:int,end:int,value:string>>"
CANDIDATE = "array<struct<begin:int,end:int,votes:string,shape:string>>"


def _scan(text: Column, pattern: str, make: Callable[[Column, Column, Column, Column], Column], valid: Callable[[Column], Column], kind: str) -> Column:
    """The valid matches from left to right, made from (begin, end, match, what stands between it and the match before)."""
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))

    def step(seen: Column, pair: Column) -> Column:
        begin = seen["at"] + F.length(pair["piece"])
        end = begin + F.length(pair["match"])
        good = F.coalesce(valid(pair["match"]), F.lit(False))
        return F.struct(end.alias("at"), F.when(good, F.concat(seen["out"], F.array(make(begin, end, pair["match"], pair["piece"])))).otherwise(seen["out"]).alias("out"))

    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(matches.alias("match"), F.split(text, pattern, -1).alias("piece"))
    return F.aggregate(pairs, start, step)["out"]


def _plain(begin: Column, end: Column, match: Column, piece: Column) -> Column:
    return F.struct(begin.alias("begin"), end.alias("end"), match.alias("value"))


def _luhn(match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return total + d - F.when(d > 9, 9).otherwise(0)

    return n.between(13, 19) & (F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0)


def _octets(match: Column) -> Column:
    return match.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")


def base_spans(text: Column) -> dict[str, Column]:
    """By kind, the spans that the fixed patterns give."""
    none = F.expr(f"cast(array() as {SPAN})")
    digit = text.rlike("[0-9]")
    long_enough = lambda m: F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)
    return {
        "email": F.when(text.contains("@"), _scan(text, EMAIL, _plain, lambda m: m.isNotNull(), SPAN)).otherwise(none),
        "ip": F.when(digit & text.contains("."), _scan(text, IP, _plain, _octets, SPAN)).otherwise(none),
        "card": F.when(digit, _scan(text, CARD, _plain, _luhn, SPAN)).otherwise(none),
        "phone": F.when(text.contains("+"), _scan(text, PHONE, _plain, long_enough, SPAN)).otherwise(none),
    }


def _any(text: Column, words: list[str]) -> Column:
    return text.rlike("(?i)(?:" + "|".join(words) + ")")


def _secret(begin: Column, end: Column, match: Column, piece: Column) -> Column:
    """Candidate credential: labelers on mixed shape, issuer, setting name before, hexadecimal digits, ordinary word."""
    before = F.right(piece, F.lit(40))
    mixed = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    votes = F.concat(
        F.when(mixed, "1").otherwise("0"),
        F.when(match.rlike("^(?:" + "|".join(ISSUED) + ")"), "1").otherwise("-"),
        F.when(before.rlike("(?i)(?:" + "|".join(SETTINGS) + ")[\"']?\\s*[=:]\\s*[\"']?$"), "1").when(before.rlike(r"\s$"), "0").otherwise("-"),
        F.when(match.rlike("^[0-9a-f]+$") & mixed, "1").otherwise("-"),
        F.when(match.rlike("^[A-Z]?[a-z]+$|^[A-Z]+$|^[A-Za-z]+(?:[-/_][A-Za-z]+)*$"), "0").otherwise("-"))
    digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    shape = F.concat(F.least(F.floor(F.length(match) / 8), F.lit(9)).cast("string"), F.least(F.floor(4 * digits / F.length(match)), F.lit(3)).cast("string"),
                     F.when(match.rlike("[A-Z]"), "u").otherwise("-"), F.when(match.rlike("[a-z]"), "l").otherwise("-"))
    return F.struct(begin.alias("begin"), end.alias("end"), votes.alias("votes"), shape.alias("shape"))


def _number(begin: Column, end: Column, match: Column, piece: Column) -> Column:
    """Candidate identity number: labelers on issued ranges, numbers known as samples, words before."""
    before = F.right(piece, F.lit(40))
    votes = F.concat(
        F.when(match.rlike("^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), "1").otherwise("0"),
        F.when(match.isin(NEVER_ISSUED), "0").otherwise("-"),
        F.when(_any(before, NUMBER_WORDS), "1").otherwise("-"))
    return F.struct(begin.alias("begin"), end.alias("end"), votes.alias("votes"), F.lit("").alias("shape"))


def _setting(begin: Column, end: Column, match: Column, piece: Column) -> Column:
    """Candidate value of a setting: labelers on the setting's name, digits and signs, mixed characters, quotes, ordinary word, place holder."""
    value = F.regexp_extract(match, r"""[=:]\s*["']?([^\s"',;<>]+)$""", 1)
    kinds = sum([value.rlike(c).cast("int") for c in ("[0-9]", "[A-Z]", "[a-z]", "[^A-Za-z0-9]")], F.lit(0))
    votes = F.concat(
        F.when(match.rlike("^(?i)(?:password|passwd|pwd|secret|api_?key|access_key)"), "1").otherwise("-"),
        F.when(value.rlike("[0-9$#@!%&*^+/_-]"), "1").otherwise("0"),
        F.when((kinds >= 2) & (F.length(value) >= 6), "1").otherwise("0"),
        F.when(match.rlike(r"""[=:]\s*["'][^"']+$"""), "1").otherwise("-"),
        F.when(value.rlike("^[A-Z]?[a-z]+[.!?]?$|^[A-Z]+$"), "0").otherwise("-"),
        F.when(value.rlike(r"^(?:[*.x_-]+|(?i:none|null|true|false))$|^[${(\[]"), "0").otherwise("-"))
    shape = F.concat(F.least(F.floor(F.length(value) / 4), F.lit(9)).cast("string"), kinds.cast("string"))
    return F.struct((end - F.length(value)).alias("begin"), end.alias("end"), votes.alias("votes"), shape.alias("shape"))


SECRET = r"(?:\G|(?<![A-Za-z0-9_+/-]))[A-Za-z0-9_+/-]{16,}+"
NUMBER = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
SETTING = r"""(?i)(?<![A-Za-z])(?:""" + "|".join(SETTINGS) + r""")["']?\s*+[=:]\s*+["']?[^\s"',;<>]{3,}"""
MORE = ["secret", "setting", "number"]


def candidates(text: Column) -> dict[str, Column]:
    """By kind, spans that the labelers vote on."""
    none = F.expr(f"cast(array() as {CANDIDATE})")
    some = lambda m: m.isNotNull()
    return {
        "secret": _scan(text, SECRET, _secret, some, CANDIDATE),
        "setting": F.when(text.rlike("[=:]"), _scan(text, SETTING, _setting, some, CANDIDATE)).otherwise(none),
        "number": F.when(text.rlike("[0-9]-[0-9]"), _scan(text, NUMBER, _number, some, CANDIDATE)).otherwise(none),
    }


def annotated(docs: DataFrame, apart: bool = True) -> DataFrame:
    """row, a struct of the columns of docs; pii_text; and a column for each kind, named after it with `pii_` before: spans and candidates.

    Candidates for the value of a setting leave out those that are candidates of their own; apart: all leave out what meets a base span.
    """
    out = docs.select(F.struct(*docs.columns).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("pii_text"))
    text = F.col("pii_text")
    out = out.withColumns({f"pii_{k}": v for k, v in {**base_spans(text), **candidates(text)}.items()})

    def without(kind: str, others: Column) -> Column:
        return F.filter(f"pii_{kind}", lambda c: ~F.exists(others, lambda b: (b["begin"] < c["end"]) & (c["begin"] < b["end"])))

    out = out.withColumn("pii_setting", without("setting", F.col("pii_secret")))
    return out.withColumns({f"pii_{k}": without(k, F.concat(*[f"pii_{k}" for k in BASE])) for k in MORE}) if apart else out


def em(counts: dict[str, float], rounds: int = 50) -> tuple[dict[str, float], float]:
    """Posteriors of vote patterns ('1' for, '0' against, '-' no vote, by labeler) and the prior.

    Each labeler is right with a rate of its own, between 0.55 and 0.99 so that none can be turned around, given the truth, and
    its silence says nothing. Starts from the majority of the votes.
    """
    post = {v: (v.count("1") + 0.5) / (v.count("1") + v.count("0") + 1) for v in counts}
    prior = 0.5
    if not counts:
        return post, prior
    labelers = range(len(next(iter(counts))))
    for _ in range(rounds):
        total = sum(counts.values())
        prior = min(max(sum(post[v] * n for v, n in counts.items()) / total, 1e-4), 1 - 1e-4)
        right = {}
        for i in labelers:
            for truth in "10":
                weight = {v: n * (post[v] if truth == "1" else 1 - post[v]) for v, n in counts.items() if v[i] != "-"}
                good = sum(w for v, w in weight.items() if v[i] == truth)
                right[i, truth] = min(max((good + 1) / (sum(weight.values()) + 2), 0.55), 0.99)
        for v in counts:
            odds = math.log(prior / (1 - prior))
            for i in labelers:
                if v[i] == "1":
                    odds += math.log(right[i, "1"] / (1 - right[i, "0"]))
                elif v[i] == "0":
                    odds += math.log((1 - right[i, "1"]) / right[i, "0"])
            post[v] = 1 / (1 + math.exp(-odds))
    return post, prior


def classifier(patterns: list[tuple[str, str, int]]) -> dict[str, float]:
    """Weights of a logistic span classifier from (votes, shape, count): one for each vote and each character of the shape, and "".

    Trained on the posteriors of `em`, a pattern counting as the square root of its spans, by gradient descent.
    """
    counts: dict[str, float] = defaultdict(float)
    for votes, _, n in patterns:
        counts[votes] += n
    post, _ = em(counts)
    rows = [(_features(v, s), post[v], math.sqrt(n)) for v, s, n in sorted(patterns)]
    weights: dict[str, float] = defaultdict(float)
    total = sum(n for _, _, n in rows)
    for _ in range(400):
        slope: dict[str, float] = defaultdict(float)
        for names, target, n in rows:
            wrong = (1 / (1 + math.exp(-max(min(sum(weights[f] for f in names), 500), -500))) - target) * n / total
            for f in names:
                slope[f] += wrong
        for f, s in slope.items():
            weights[f] -= 1.0 * (s + 1e-4 * weights[f])
    return dict(weights)


def _features(votes: str, shape: str) -> list[str]:
    return ["", *[f"v{i}{c}" for i, c in enumerate(votes)], *[f"s{i}{c}" for i, c in enumerate(shape)]]


def fit(marked: DataFrame) -> dict[str, dict[str, float]]:
    """A classifier for each further kind, from the candidates of all rows."""
    def voted(kind: str) -> Column:
        return F.transform(f"pii_{kind}", lambda c: F.struct(F.lit(kind).alias("kind"), c["votes"].alias("votes"), c["shape"].alias("shape")))

    all_ = F.concat(*map(voted, MORE))
    counted = marked.select(F.explode(all_).alias("c")).groupBy("c.kind", "c.votes", "c.shape").count().collect()  # distinct patterns
    return {k: classifier([(r.votes, r.shape, r["count"]) for r in counted if r.kind == k]) for k in MORE}


def _accepted(kind: str, weights: dict[str, float]) -> Column:
    """The candidates that the classifier takes, as spans."""
    if not weights:
        return F.expr(f"cast(array() as {SPAN})")

    def good(c: Column) -> Column:
        score = F.lit(weights.get("", 0.0))
        for name, w in sorted(weights.items()):
            if name:
                column, i = ("votes", int(name[1])) if name[0] == "v" else ("shape", int(name[1]))
                score = score + F.when(F.substring(c[column], i + 1, 1) == name[2:], w).otherwise(0.0)
        return (score > 0) & c["votes"].contains("1")  # what no labeler is for is not taken

    return F.transform(F.filter(f"pii_{kind}", good), lambda c: F.struct(c["begin"], c["end"], F.lit(None).cast("string").alias("value")))


def classified(marked: DataFrame, models: dict[str, dict[str, float]]) -> DataFrame:
    return marked.withColumns({f"pii_{k}": _accepted(k, models[k]) for k in MORE})


def _listed(kinds: list[str]) -> Column:
    def own(kind: str) -> Column:
        return F.transform(f"pii_{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["begin"], s["end"]))

    return F.concat_ws(",", *map(own, kinds))


def spans(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_secret, n_setting, n_number.

    spans: kind:begin:end (code points, end exclusive) by kind as listed and then begin, comma-joined; base_sha256 is the digest
    of such a list of the base kinds alone. The method adds kinds (secret, setting, number); base spans stay. Null and empty texts have
    no spans; repeated rows keep their rows, a null doc_id stays null; an empty table gives no rows; other columns are ignored.
    """
    marked = annotated(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    marked = written(marked.select("row.doc_id", *[f"pii_{k}" for k in BASE + MORE]), "marked")
    done = classified(marked, fit(marked))
    counts = [F.size(f"pii_{k}").cast("long").alias(f"n_{k}") for k in BASE + MORE]
    return done.select("doc_id", *counts[:4], F.sha2(_listed(BASE), 256).alias("base_sha256"), _listed(BASE + MORE).alias("spans"), *counts[4:])


def masked(docs: DataFrame) -> DataFrame:
    """docs with `<KIND>` in place of every span of their texts; spans that overlap are replaced together, by the kind that begins first.

    A candidate that the classifier takes is replaced whole, also where a base span lies within. n_chars, where there is one,
    follows the new text. Null texts stay null; rows without spans are unchanged, repeated rows keep their rows; other columns
    are kept, whatever their names; an empty table gives no rows. Texts are searched once and written with their spans.
    """
    marked = written(annotated(docs, apart=False).drop("pii_text"), "marked")
    done = classified(marked, fit(marked))

    def named(kind: str) -> Column:
        return F.transform(f"pii_{kind}", lambda s: F.struct(s["begin"].alias("begin"), s["end"].alias("end"), F.lit(kind).alias("kind")))

    done = done.select("row", F.sort_array(F.concat(*map(named, BASE + MORE))).alias("all"))
    old = F.col("row.text").cast("string")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(seen: Column, s: Column) -> Column:
        mark = F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))
        longer = F.concat(seen["out"], old.substr(seen["at"] + 1, s["begin"] - seen["at"]), mark)
        over = s["begin"] < seen["at"]
        return F.struct(F.when(over, F.greatest(seen["at"], s["end"])).otherwise(s["end"]).alias("at"), F.when(over, seen["out"]).otherwise(longer).alias("out"))

    done = done.select("row", F.when(F.size("all") > 0, F.aggregate("all", start, step)).alias("done"))
    text = F.when(F.col("done").isNull(), F.col("row.text")).otherwise(F.concat("done.out", old.substr(F.col("done.at") + 1, F.length(old))))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("done").isNull(), F.col("row.n_chars")).otherwise(F.length(text).cast(docs.schema["n_chars"].dataType))
    return done.select(*[changed[c].alias(c) if c in changed else F.col("row")[c].alias(c) for c in docs.columns])
