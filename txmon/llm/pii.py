"""Personal data by weak supervision, in SQL functions only.

Patterns propose spans. Labelers (regex, gazetteer, context) vote on each; expectation-
maximisation over the counts of vote patterns estimates how reliable they are, and a logistic
span classifier is trained on the resulting soft labels. Spans of the base patterns always
stay; the classifier decides on the others. The counts have at most kinds x 3^labelers rows,
whatever the corpus; every span of the corpus is in them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txmon.llm.common import documents, let, store

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "secret")
EMAIL, IP, CARD, PHONE, IBAN, SSN, SECRET = range(len(KINDS))
LABELERS = ("regex", "shape", "gazetteer", "context", "counter", "edges")

# Base patterns. Possessive repeats and the guards in front only spare retries that can't
# succeed: where a run of characters failed as a whole, no later start in it succeeds.
_BASE = {
    EMAIL: "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    IP: "(?<![0-9])[0-9]++(?:\\.[0-9]++)(?:\\.[0-9]++)(?:\\.[0-9]++)",
    CARD: "[0-9](?:[ -]?[0-9])++",
    PHONE: "\\+[0-9][ ().0-9-]+[0-9]",
}
# What a rarer writing of the same, or another kind, looks like.
_OTHER = {
    SECRET: "(?:[Pp]assword|[Pp]asswd|[Ss]ecret|[Tt]oken|[Aa]pi[_-]?[Kk]ey)[\"']?[ ]?[=:][ ]?[\"']?"
    "[A-Za-z0-9+/_-]{8,}+|(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}"
    "|sk-[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])",
    IBAN: "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    SSN: "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    PHONE: "(?<![0-9A-Za-z+(.-])\\(?[0-9]{3}\\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z-])",
    EMAIL: "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?[(\\[](?:at|AT)[)\\]] ?[A-Za-z0-9-]++"
    "(?: ?[(\\[](?:dot|DOT)[)\\]] ?[A-Za-z0-9-]++)++",
}
# What a text must have for a pattern to be worth a search.
_HINT = {
    EMAIL: "@",
    IP: "[0-9]\\.[0-9]",
    CARD: "[0-9][ -]?[0-9]",
    PHONE: "\\+[0-9]",
}
_OTHER_HINT = "[0-9=:]|[(\\[](?:at|AT)[)\\]]|AKIA|ghp_|sk-"
_CONTEXT = 24
# Gazetteers.
TOP_LEVEL = (
    "com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "us", "it", "nl",
    "ch", "at", "be", "eu", "ca", "au", "jp", "cn", "in", "br", "ru", "pl", "se", "no", "dk",
)
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45",
                 "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "90", "91")
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "6011", "65", "35", "62")
RESERVED_NETS = ("0.", "127.", "255.")
KEY_PREFIXES = ("AKIA", "ghp_", "sk-")
FOR_WORDS = (
    "mail", "contact", "call", "phone", "tel", "fax", "mobile", "card", "visa", "credit", "server",
    "host", "addr", "password", "token", "secret", "key", "account", "iban", "ssn", "social",
)
AGAINST_WORDS = ("version", "isbn", "order", "invoice", "page", "figure", "chapter", "section",
                 "build", "release", "article", "room")

_SPAN = (
    "array<struct<start:int,kind:int,end:int,match:string,left:string,right:string,base:boolean>>"
)


def _located(text: Column, pattern: str, hint: str) -> Column:
    """Matches with code point places and what stands beside them; none without the hint.

    The text split at the pattern gives what lies between matches; lengths add up to places.
    """
    kind = "struct<at:int,out:array<struct<start:int,end:int,match:string,left:string,right:string>>>"
    start = F.from_json(F.lit('{"at":0,"out":[]}'), kind)

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["before"])
        return let(
            begin,
            lambda b: F.struct(
                (b + F.length(x["match"])).alias("at"),
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            b.alias("start"),
                            (b + F.length(x["match"])).alias("end"),
                            x["match"].alias("match"),
                            F.right(x["before"], F.lit(_CONTEXT)).alias("left"),
                            F.left(x["after"], F.lit(_CONTEXT)).alias("right"),
                        )
                    ),
                ).alias("out"),
            ).cast(kind),
        )

    def placed(found: Column) -> Column:
        return let(
            F.split(text, pattern, -1),
            lambda gaps: F.aggregate(
                F.transform(
                    found,
                    lambda m, i: F.struct(
                        m.alias("match"),
                        F.get(gaps, i).alias("before"),
                        F.get(gaps, i + 1).alias("after"),
                    ),
                ),
                start,
                step,
            )["out"],
        )

    return F.when(
        text.rlike(hint),
        let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            lambda found: F.when(F.size(found) > 0, placed(found)).otherwise(start["out"]),
        ),
    ).otherwise(start["out"])


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """The check sum of card numbers holds."""
    each = F.filter(F.split(F.reverse(digits), ""), lambda d: d != "")
    values = F.transform(
        each,
        lambda d, i: let(
            d.cast("int") * (i % 2 + 1), lambda v: F.when(v > 9, v - 9).otherwise(v)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def _byte_parts(match: Column) -> Column:
    """No part of a dotted number is above 255."""

    def low(part: Column) -> Column:
        short = F.ltrim(part, F.lit("0"))
        return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))

    return F.forall(F.split(match, "\\."), low)


def _is_base(kind: int, match: Column) -> Column:
    if kind == IP:
        return _byte_parts(match)
    if kind == CARD:
        return let(
            _digits(match),
            lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False),
        )
    if kind == PHONE:
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _spans(found: Column, kind: Column, base: Column | None) -> Column:
    return F.transform(
        found,
        lambda x: F.struct(
            x["start"],
            (kind if not callable(kind) else kind(x["match"])).alias("kind"),
            x["end"],
            x["match"],
            x["left"],
            x["right"],
            (base(x["match"]) if base else F.lit(False)).alias("base"),
        ),
    ).cast(_SPAN)


def _other_kind(match: Column) -> Column:
    """Which of the other patterns made a match; they are tried in this order."""
    chosen = F.lit(SECRET)
    for kind, pattern in reversed(_OTHER.items()):
        bare = pattern
        if kind != SECRET:
            bare = f"^(?:{pattern})$"
            chosen = F.when(match.rlike(bare), F.lit(kind)).otherwise(chosen)
    return chosen


def candidates(text: Column) -> Column:
    """All proposed spans by place: of the base patterns, and others where none of them lies."""
    based = [
        _spans(_located(text, p, _HINT[k]), F.lit(k), lambda m, k=k: _is_base(k, m))
        for k, p in _BASE.items()
    ]
    # A run of digits is a candidate for a card number only if it is long enough for one.
    based[2] = F.filter(based[2], lambda x: x["base"] | F.length(_digits(x["match"])).between(12, 19))
    found = _located(text, "|".join(_OTHER.values()), _OTHER_HINT)
    other = _spans(found, _other_kind, None)
    strict = F.concat(*based)

    def joined(own: Column) -> Column:
        sure = F.filter(own, lambda x: x["base"])
        return let(
            sure,
            lambda fixed: F.sort_array(
                F.concat(
                    fixed,
                    F.filter(
                        F.concat(F.filter(own, lambda x: ~x["base"]), other),
                        lambda x: ~F.exists(
                            fixed, lambda y: (y["start"] < x["end"]) & (x["start"] < y["end"])
                        ),
                    ),
                )
            ),
        )

    return let(strict, joined)


def _any_of(text: Column, words: tuple[str, ...], start: bool = False) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | (text.startswith(word) if start else text.contains(word))
    return found


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def votes(x: Column) -> Column:
    """What every labeler says of a span: 1 personal data, -1 not, 0 nothing."""
    kind, match = x["kind"], x["match"]
    digits = _digits(match)
    of = lambda *kinds: kind.isin(*kinds)
    numeric = of(IP, CARD, PHONE)
    shape = (
        F.when(of(EMAIL), _vote(match.rlike("[.\\])] ?[A-Za-z]{2,24}$"), F.lit(True)))
        .when(of(IP), _vote(~match.rlike("(^|\\.)0[0-9]"), F.lit(True)))
        .when(of(CARD), _vote(match.rlike("^([0-9]+|[0-9]{4}([ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$"), F.lit(True)))
        .when(of(PHONE), _vote(match.rlike("[0-9]{3}[ .-]?[0-9]{4}$|( [0-9]{2,4}){2,}$"), F.lit(False)))
        .when(of(IBAN), _vote(F.length(F.translate(match, " ", "")).between(15, 34), F.lit(True)))
        .when(of(SSN), _vote(~match.rlike("^(000|666|9)|-00-|-0000$"), F.lit(True)))
        .otherwise(_vote(match.rlike("[0-9]") & match.rlike("[A-Za-z]"), F.lit(True)))
    )
    gazetteer = (
        F.when(of(EMAIL), _vote(F.lower(F.regexp_extract(match, "([A-Za-z]+)$", 1)).isin(*TOP_LEVEL), F.lit(False)))
        .when(of(IP), _vote(F.lit(False), _any_of(match, RESERVED_NETS, True)))
        .when(of(CARD), _vote(_any_of(digits, CARD_PREFIXES, True), F.lit(True)))
        .when(of(PHONE), _vote(_any_of(digits, COUNTRY_CODES, True) & match.startswith("+"), F.lit(False)))
        .when(of(SECRET), _vote(_any_of(match, KEY_PREFIXES, True), F.lit(False)))
        .otherwise(0)
    )
    left = F.lower(x["left"])
    edge = F.right(x["left"], F.lit(1)).rlike("[A-Za-z0-9]") | F.left(x["right"], F.lit(1)).rlike("[A-Za-z0-9]")
    return F.struct(
        _vote(x["base"], numeric).alias("regex"),
        shape.alias("shape"),
        gazetteer.alias("gazetteer"),
        _vote(_any_of(left, FOR_WORDS) | (of(SECRET) & match.rlike("[=:]")), F.lit(False)).alias("context"),
        _vote(F.lit(False), _any_of(left, AGAINST_WORDS)).alias("counter"),
        _vote(~edge, F.lit(True)).alias("edges"),
    )


@dataclass(frozen=True)
class SpanModel:
    """Labelers' reliabilities, and weights of the span classifier: bias, votes, kinds."""

    prior: float
    # By labeler, class (not, is) and vote (-1, 0, 1).
    reliability: np.ndarray = field(repr=False)
    weights: np.ndarray = field(repr=False)

    def accepts(self, x: Column, said: Column) -> Column:
        score = F.lit(float(self.weights[0]))
        for w, name in zip(self.weights[1:], LABELERS, strict=False):
            score = score + F.lit(float(w)) * said[name]
        for w, k in zip(self.weights[1 + len(LABELERS) :], range(len(KINDS)), strict=True):
            score = score + F.when(x["kind"] == k, F.lit(float(w))).otherwise(0.0)
        return score >= 0


def vote_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """How many spans of the corpus have each kind and pattern of votes."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    spans = docs.select(F.explode(candidates(text)).alias("x"))
    said = spans.select(F.col("x.kind").alias("kind"), votes(F.col("x")).alias("said"))
    return said.select("kind", "said.*").groupBy("kind", *LABELERS).agg(F.count("*").alias("n"))


def train(counts: DataFrame, rounds: int = 8, steps: int = 6) -> SpanModel:
    """Expectation-maximisation over vote patterns, then Newton steps of the classifier.

    Each round is one aggregation of the counts, with a row for each vote of a labeler or pair of
    inputs rather than a column, and with parameters in an array, so that rounds share their
    code: the driver plans and keeps little. Without any spans the classifier weighs all
    votes alike.
    """
    names = [F.col(name).cast("int") for name in LABELERS]
    inputs = [F.lit(1.0), *(x.cast("double") for x in names)]
    inputs += [F.when(F.col("kind") == k, 1.0).otherwise(0.0) for k in range(len(KINDS))]
    # In a fixed order and one file: sums of doubles depend on it. All rows vote 0 in place 0.
    known = store(
        counts.orderBy("kind", *LABELERS)
        .coalesce(1)
        .select("n", F.array(F.lit(0), *names).alias("said"), F.array(*inputs).alias("x")),
        "pii-patterns",
    )
    total = F.aggregate("said", F.lit(0), lambda sum_, v: sum_ + v)
    label = F.when(total > 0, 0.9).when(total < 0, 0.1).otherwise(0.5)
    prior, reliability = 0.5, np.full((len(LABELERS), 2, 3), 1 / 3)
    for _ in range(rounds):
        rows = (
            known.select("n", "said", label.alias("y"))
            .select("n", "y", F.posexplode("said").alias("at", "vote"))
            .groupBy("at", "vote")
            .agg(F.sum(F.col("n") * (1 - F.col("y"))), F.sum(F.col("n") * F.col("y")))
            .collect()
        )  # at most three a labeler
        if not rows:
            weights = np.zeros(1 + len(LABELERS) + len(KINDS))
            weights[1 : 1 + len(LABELERS)] = 1
            return SpanModel(prior, reliability, weights)
        cells = np.zeros((1 + len(LABELERS), 2, 3))
        for at, vote, *sums in rows:
            cells[at, :, vote + 1] = sums
        mass = cells[0, :, 1]
        prior = round(float((mass[1] + 1) / (mass.sum() + 2)), 9)
        # A vote more in every cell, so that no probability is 0.
        cells = cells[1:] + 1
        reliability = np.round(cells / cells.sum(axis=2, keepdims=True), 9)
        terms = [math.log(prior / (1 - prior))]
        for own in reliability:
            terms += np.log(own[1] / own[0]).tolist()
        held = F.lit(terms)
        odds = F.get(held, F.lit(0))
        for j in range(1, 1 + len(LABELERS)):
            odds = odds + F.get(held, F.get("said", F.lit(j)) + (3 * j - 1))
        label = 1 / (1 + F.exp(-odds))

    labelled = store(known.select("n", label.alias("y"), "x"), "pii-labels")
    weights = np.zeros(len(inputs))
    for _ in range(steps):
        terms = F.zip_with("x", F.lit(weights.tolist()), lambda x, w: w * x)
        score = F.aggregate(terms, F.lit(0.0), lambda sum_, v: sum_ + v)
        rows = (
            labelled.select("n", "y", "x", (1 / (1 + F.exp(-score))).alias("p"))
            .select("n", "y", "x", "p", F.posexplode("x").alias("i", "a"))
            .select("*", F.posexplode(F.slice("x", F.lit(1), F.col("i") + 1)).alias("j", "b"))
            .groupBy("i", "j")
            .agg(
                F.sum(F.col("n") * (F.col("y") - F.col("p")) * F.col("a")),
                F.sum(F.col("n") * F.col("p") * (1 - F.col("p")) * F.col("a") * F.col("b")),
            )
            .collect()
        )  # one a pair of inputs
        slope = np.zeros(len(inputs))
        curve = np.eye(len(inputs))
        for i, j, first, second in rows:
            curve[i, j] += second
            if i != j:
                curve[j, i] += second
            else:
                slope[i] = first
        weights = np.round(weights + np.clip(np.linalg.solve(curve, slope - weights), -4, 4), 9)
    return SpanModel(prior, reliability, weights)


def found_spans(text: Column, model: SpanModel) -> Column:
    """Spans of a text by place: base ones, and others that the classifier accepts."""

    def kept(x: Column) -> Column:
        return x["base"] | let(votes(x), lambda said: model.accepts(x, said))

    return F.filter(candidates(F.coalesce(text, F.lit(""))), kept)


def _named(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(
                ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")
            ),
        ),
        ",",
    )


def find_pii(
    docs: DataFrame, model: SpanModel | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, found)``: the spans of every row as structs with kind, start, end, match, base.

    Places are code points, end exclusive. A NULL text is empty; every row gives a row,
    repeated ones too. Without a ``model`` one is trained on all rows first. Base spans of
    different kinds may overlap; others never overlap a base span. Other columns are ignored.
    """
    if model is None:
        model = train(store(vote_counts(docs, text_col), "pii-votes"))
    return docs.select(
        F.col(id_col).alias("doc_id"), found_spans(F.col(text_col), model).alias("found")
    )


def masked(text: Column, spans: Column) -> Column:
    """The text with each span, overlapping ones together, replaced by the kind in brackets."""
    names = F.array(*map(F.lit, KINDS))
    kind = "struct<at:int,out:string>"

    def step(acc: Column, x: Column) -> Column:
        mark = F.concat(F.lit("["), F.upper(F.get(names, x["kind"])), F.lit("]"))
        between = F.substr(text, acc["at"] + 1, x["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], x["end"]).alias("at"),
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], between, mark))
            .otherwise(acc["out"])
            .alias("out"),
        ).cast(kind)

    start = F.from_json(F.lit('{"at":0,"out":""}'), kind)
    return F.when(F.size(spans) == 0, text).otherwise(
        let(
            F.aggregate(spans, start, step),
            lambda end: F.concat(end["out"], F.substr(text, end["at"] + 1, F.length(text))),
        )
    )


def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    found = find_pii(documents(spark, sf_dir)).select(
        "doc_id", "found", F.filter("found", lambda x: x["base"]).alias("base")
    )
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{KINDS[k]}") for k in (EMAIL, IP, CARD, PHONE)),
        F.sha2(_named(F.col("base")), 256).alias("base_sha256"),
        _named(F.col("found")).alias("spans"),
    )
