"""Personal data and secrets by weak supervision.

Patterns propose spans: the strict forms of four kinds, whose valid matches always stand, and
looser forms that the strict ones miss (national phone numbers of several countries, mail
addresses spelled out, card numbers with other separators or a wrong check digit, keys and
access tokens). Four labelers vote on each span, strict or loose alike: its form (check
digit, number of digits, mix of characters), a gazetteer (domain endings, area codes, card
issuers, address ranges, key prefixes), the words around it, and its borders. Which pattern
proposed a span is no vote. Expectation-maximisation over the counts of vote patterns
estimates how reliable each vote is per kind. Its probabilities then train the span
classifier, naive Bayes over the votes and the span's length, and looser spans that it
accepts are added.

Texts stay in Spark expressions. Only the counts of vote patterns leave it, at most
``5 kinds * 3 ** 4 votes * 4 lengths`` numbers whatever the input.

Patterns are written so that none can take quadratic time or deep recursion: a match begins
where a run of its characters begins, or where the match before it ended.
"""

from __future__ import annotations

from collections.abc import Iterable
from math import exp, log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.text import at_end, first_step, next_step, whole
from headway.sources.scratch import new_folder, written

# Kinds in order, and their strict forms. Possessive repetition and the start
# condition change no match.
KINDS = ("email", "ip", "card", "phone")
_ALL = (*KINDS, "secret")
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text that fails the test has no match.
_DIGITS_IN_TEXT = r"text RLIKE '[0-9][\\x20-]?[0-9]'"
_NEEDLES = {"email": "contains(text, '@')", "ip": "contains(text, '.')", "card": _DIGITS_IN_TEXT, "phone": "contains(text, '+')"}
_USER, _LABEL = r"[A-Za-z0-9._%+-]{1,64}+", r"[A-Za-z0-9-]{1,63}+"
_LOOSE = {
    # In brackets, as words, or set apart by spaces.
    "email": rf"(?<![A-Za-z0-9._%+-]){_USER}(?:"
    rf"\x20?[\[({{]at[\])}}]\x20?{_LABEL}(?:(?:\x20?[\[({{]dot[\])}}]\x20?|\.){_LABEL}){{1,8}}+"
    rf"|\x20at\x20{_LABEL}(?:\x20dot\x20{_LABEL}){{1,8}}+|\x20@\x20{_LABEL}(?:\.{_LABEL}){{1,8}}+)",
    "card": r"(?<![0-9.])[0-9]{4}(?:(?:[./_]|\x20[\x20-]\x20?)[0-9]{4}){3}(?![0-9]|\.[0-9])",
    # Valid strict numbers are passed over whole, so that nothing inside them is proposed.
    # Then North American numbers, European ones in pairs and in threes, numbers with a trunk
    # zero, and international ones behind 00.
    "phone": r"\+[0-9](?:[\x20().-]*+[0-9]){9,14}+(?![\x20().-]*+[0-9])"
    r"|(?<![0-9+.-])(?<![0-9][\x20])(?:(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}"
    r"|0[1-9](?:[\x20.-][0-9]{2}){4}|[6-9][0-9]{2}(?:[\x20.-][0-9]{3}){2}"
    r"|(?:\(0[0-9]{2,4}\)|0[0-9]{2,4})[\x20/-]{1,3}[0-9]{3,4}[\x20-]?[0-9]{3,5}"
    r"|00[1-9](?:[\x20().-]{0,3}[0-9]){9,13})(?![0-9-]|[\x20.][0-9])",
    "secret": r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
}
_LOOSE_NEEDLES = {
    "email": r"text RLIKE '[\\[({\\x20]at[\\])}\\x20]|\\x20@\\x20'",
    "card": _DIGITS_IN_TEXT,
    "phone": _DIGITS_IN_TEXT,
    "secret": "text RLIKE '[A-Za-z0-9_-]{20}'",
}
_LOOSE_KEPT = {
    "email": "true",
    "card": "true",
    "phone": "left(v.value, 1) <> '+'",
    "secret": "v.value RLIKE '[0-9]' AND v.value RLIKE '[A-Za-z]'",
}
# Gazetteers: what the values of each kind usually begin or end with.
_KNOWN = {
    "email": r"(?i)[.\x20)\]}](?:[a-z]{2}|com|org|net|edu|gov|int|mil|info|biz|name|app|dev|cloud|online|shop)$",
    "ip": r"^(?!0\.|127\.|22[4-9]\.|2[3-5][0-9]\.)",
    "card": r"^(?:3[04-9]|4|5[1-5]|2[2-7]|6)",
    "phone": r"^(?:\+[1-9]|00[1-9]|\(?0[1-9]|\(?[2-9])",
    "secret": r"^(?:[spr]k[-_]|gh[a-z]_|AKIA|AIza|xox|eyJ|glpat-)",
}
_CUES = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|to|from|reach|courriel|correo|contacto|kontakt|schreib)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|addr|client|ping|login|adresse|direcci.n|serveur|servidor)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|pay|payment|carte|tarjeta|karte|kreditkarte|cr.dito)\b",
    "phone": r"(?i)\b(?:phone|tel|telephone|mobile|call|fax|cell|dial|whatsapp|telefon|tfno|t.l.phone|tel.fono|appelez|ruf|llame|handy|portable)\b",
    "secret": r"(?i)(?:\b|_)(?:token|secret|key|apikey|password|passwd|pwd|auth|bearer|credentials?|access|clave|passwort)\b",
}
_COUNTER_CUES = r"(?i)(?:\b(?:version|token|id|key|hash|isbn|sku|order|ref|build|section|serial|uuid)\b|[=#\"])"
_SECRET_COUNTER_CUES = r"(?i)\b(?:commit|sha-?[0-9]+|md5|hash|digest|checksum|uuid|etag|revision|file|isbn|https?|www)\b|/"
_AROUND = 30
_LENGTHS = (11, 15, 20)
VOTES = ("form", "known", "context", "border")


def _found(pattern: str, check: str) -> str:
    """SQL: array of (start, end, value) of all matches in ``text``, in code points.

    What lies between matches comes from splitting at them, so a start is the length of all
    before it.
    """
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    empty = "CAST(array() AS array<struct<start: int, past: int, value: string>>)"
    return f"""
CASE WHEN {check} AND text RLIKE '{p}' THEN
  transform(array(named_struct('m', regexp_extract_all(text, '{p}', 0), 'b', split(text, '{p}', -1))), x ->
    aggregate(sequence(0, size(x.m) - 1),
      named_struct('at', 0, 'out', {empty}),
      (acc, i) -> named_struct(
        'at', acc.at + length(x.b[i]) + length(x.m[i]),
        'out', concat(acc.out, array(named_struct(
          'start', acc.at + length(x.b[i]), 'past', acc.at + length(x.b[i]) + length(x.m[i]), 'value', x.m[i])))),
      acc -> acc.out))[0]
ELSE {empty} END"""


_DIGITS = "regexp_replace(v.value, '[^0-9]', '')"
# Luhn: from the right, every second digit doubled, sums of digits, a multiple of ten.
_LUHN = """(aggregate(sequence(1, length(d)), 0, (sum, i) -> sum + CASE
  WHEN i % 2 = 1 THEN CAST(substr(d, length(d) - i + 1, 1) AS int)
  WHEN CAST(substr(d, length(d) - i + 1, 1) AS int) * 2 > 9 THEN CAST(substr(d, length(d) - i + 1, 1) AS int) * 2 - 9
  ELSE CAST(substr(d, length(d) - i + 1, 1) AS int) * 2 END) % 10 = 0)"""
_VALID = {
    "email": "true",
    "ip": "forall(split(v.value, '\\\\.'), p -> length(ltrim('0', p)) <= 3 AND coalesce(try_cast(right(p, 9) AS int), 999) <= 255)",
    "card": f"length({_DIGITS}) BETWEEN 14 AND 19 AND exists(array({_DIGITS}), d -> {_LUHN})",
    "phone": f"length({_DIGITS}) BETWEEN 10 AND 15",
}
# How a value keeps the rules of its kind beyond the pattern: 2 for, 1 none, 0 against.
_FORM = {
    "email": r"CASE WHEN v.value RLIKE '^[A-Za-z0-9].*[.\\x20)\\]}][A-Za-z]{2,24}$' THEN 2 ELSE 0 END",
    "ip": r"CASE WHEN v.value RLIKE '^(?:[1-9][0-9]*|0)(?:\\.(?:[1-9][0-9]*|0)){3}$' THEN 2 ELSE 0 END",
    "card": f"CASE WHEN {_VALID['card']} THEN 2 ELSE 0 END",
    "phone": f"CASE WHEN length({_DIGITS}) BETWEEN 10 AND 15 THEN 2 WHEN length({_DIGITS}) = 9 THEN 1 ELSE 0 END",
    "secret": "CASE WHEN v.value RLIKE '[-_][A-Za-z]+[-_]' THEN 0 WHEN v.value RLIKE '^(?:[0-9a-f]{32,}|[0-9A-F]{32,})$'"
    " OR (v.value RLIKE '[a-z]' AND v.value RLIKE '[A-Z]') THEN 2 ELSE 1 END",
}
# Loose values that are not valid strict ones but may still be personal data.
_PLAUSIBLE = {
    "ip": "false",
    "card": f"length({_DIGITS}) BETWEEN 14 AND 19",
    "phone": "false",
    "email": "false",
}


def _typed(kind: str, matches: str, strict: bool) -> str:
    """SQL: matches as spans (start, place of the kind, past, strict, value)."""
    keep = (
        f"({_VALID[kind]}) OR ({_PLAUSIBLE[kind]})" if strict else _LOOSE_KEPT[kind]
    )
    valid = f"({_VALID[kind]})" if strict else "false"
    return f"""transform(filter({matches}, v -> {keep}), v -> named_struct(
  'start', v.start, 'kind', {_ALL.index(kind)}, 'past', v.past, 'strict', {valid}, 'value', v.value))"""


def _vote(condition: str, against: str) -> str:
    return f"CASE WHEN {condition} THEN 2 WHEN {against} THEN 0 ELSE 1 END"


def _pattern_number() -> str:
    """SQL: one number for a span's kind, votes (0 against, 1 none, 2 for) and length."""

    quoted = lambda t: t.replace("\\", "\\\\").replace("'", "\\'")
    case = lambda by: "CASE v.kind " + " ".join(f"WHEN {i} THEN {by(k)}" for i, k in enumerate(_ALL)) + " END"
    before = f"substr(text, greatest(v.start - {_AROUND}, 0) + 1, v.start - greatest(v.start - {_AROUND}, 0))"
    against = case(lambda k: f"{before} RLIKE '{quoted(_SECRET_COUNTER_CUES if k == 'secret' else _COUNTER_CUES)}'")
    glued = "(substr(text, v.start, 1) RLIKE '[A-Za-z0-9]' AND v.start > 0) OR substr(text, v.past + 1, 1) RLIKE '[A-Za-z0-9]'"
    votes = [
        case(lambda k: f"({_FORM[k]})"),
        _vote(case(lambda k: f"v.value RLIKE '{quoted(_KNOWN[k])}'"), "true"),
        _vote(case(lambda k: f"{before} RLIKE '{quoted(_CUES[k])}'"), against),
        _vote(f"NOT ({glued})", "true"),
    ]
    length = "CASE " + " ".join(f"WHEN length(v.value) <= {n} THEN {i}" for i, n in enumerate(_LENGTHS)) + f" ELSE {len(_LENGTHS)} END"
    number = "v.kind"
    for vote in votes:
        number = f"({number} * 3 + ({vote}))"
    return f"{number} * {len(_LENGTHS) + 1} + {length}"


class Pattern(NamedTuple):
    kind: int
    votes: tuple[int, ...]
    length: int


def read_number(number: int) -> Pattern:
    number, length = divmod(number, len(_LENGTHS) + 1)
    votes = []
    for _ in VOTES:
        number, vote = divmod(number, 3)
        votes.append(vote)
    return Pattern(number, tuple(reversed(votes)), length)


def reliabilities(counts: dict[Pattern, int], rounds: int = 40) -> dict[Pattern, float]:
    """Probability of every pattern to be personal data, by expectation-maximisation.

    Per kind: a share of true spans and, for true and false spans, the chances of each
    labeler's three votes. Spans start by how many votes are for them.
    """
    posterior = {}
    for p in counts:
        posterior[p] = min(0.95, max(0.05, 0.5 + 0.15 * sum(v - 1 for v in p.votes)))
    for _ in range(rounds):
        updated = {}
        for kind in {p.kind for p in counts}:
            own = {p: n for p, n in counts.items() if p.kind == kind}
            mass = [1.0, 1.0]
            chance = [[[1.0] * 3 for _ in VOTES] for _ in range(2)]
            for p, n in own.items():
                for truth, share in ((1, posterior[p]), (0, 1 - posterior[p])):
                    mass[truth] += n * share
                    for labeler, vote in enumerate(p.votes):
                        chance[truth][labeler][vote] += n * share
            for p in own:
                score = log(mass[1] / mass[0])
                for labeler, vote in enumerate(p.votes):
                    yes, no = (chance[t][labeler][vote] / sum(chance[t][labeler]) for t in (1, 0))
                    score += log(yes / no)
                updated[p] = 1 / (1 + exp(-max(-30.0, min(30.0, score))))
        posterior = updated
    return posterior


def accepted(counts: dict[Pattern, int], at_least: float) -> list[Pattern]:
    """Patterns that the classifier accepts.

    Naive Bayes over kind, votes and length, trained on all spans weighted by their
    probabilities. There must also be more votes for than against.
    """
    posterior = reliabilities(counts)
    chosen = []
    for kind in {p.kind for p in counts}:
        own = {p: n for p, n in counts.items() if p.kind == kind}
        mass = [1.0, 1.0]
        features: dict[tuple, list[float]] = {}
        for p, n in own.items():
            for truth, share in ((1, posterior[p]), (0, 1 - posterior[p])):
                mass[truth] += n * share
                for feature in (*enumerate(p.votes), ("length", p.length)):
                    features.setdefault(feature, [1.0, 1.0])[truth] += n * share
        for p in own:
            score = log(mass[1] / mass[0])
            for feature in (*enumerate(p.votes), ("length", p.length)):
                score += log(features[feature][1] / (mass[1] + 2)) - log(features[feature][0] / (mass[0] + 2))
            if sum(v - 1 for v in p.votes) > 0 and score >= log(at_least / (1 - at_least)):
                chosen.append(p)
    return sorted(chosen)


def _number(pattern: Pattern) -> int:
    number = pattern.kind
    for vote in pattern.votes:
        number = number * 3 + vote
    return number * (len(_LENGTHS) + 1) + pattern.length


def _spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, spans, step): all proposed spans of every text, numbered by their pattern."""
    rows = docs.select(F.col(id_col).alias("id"), whole(text_col).alias("text"), first_step())
    names = []
    for kind in KINDS:
        rows = rows.select("id", "text", *names, F.expr(_found(STRICT[kind], _NEEDLES[kind])).alias(kind), next_step())
        names.append(kind)
    for kind, pattern in _LOOSE.items():
        found = F.expr(_found(pattern, _LOOSE_NEEDLES[kind])).alias(f"loose_{kind}")
        rows = rows.select("id", "text", *names, found, next_step())
        names.append(f"loose_{kind}")
    typed = [_typed(k, k, True) for k in KINDS] + [_typed(k, f"loose_{k}", False) for k in _LOOSE]
    rows = rows.select("id", "text", F.expr(f"concat({', '.join(typed)})").alias("spans"), next_step())
    numbered = f"""transform(spans, v -> named_struct(
  'start', v.start, 'kind', v.kind, 'past', v.past, 'strict', v.strict, 'number', {_pattern_number()}))"""
    return rows.select("id", F.expr(numbered).alias("spans"), next_step())


def _joined(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in _ALL))
    return F.array_join(
        F.transform(
            F.array_sort(spans), lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["past"].cast("string"))
        ),
        ",",
    )


def _counts(rows: Iterable) -> dict[Pattern, int]:
    return {read_number(r["number"]): r["n"] for r in rows}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", at_least: float = 0.95) -> DataFrame:
    """(id, base, spans) per row: both arrays of (start, kind, past, strict, number).

    ``base`` holds the valid strict spans of the four kinds, ``spans`` also the added ones,
    secrets among them, both by start, then kind; an added span never overlaps a base one. A
    null text counts as empty and has no spans. Repeated rows give repeated results, an empty table none; other columns
    are not looked at.
    """
    found = written(
        _spans(docs, id_col, text_col).select("id", at_end(F.col("spans")).alias("spans")),
        new_folder(docs.sparkSession, "spans"),
    )
    counted = found.select(F.explode("spans.number").alias("number")).groupBy("number").agg(F.count("*").alias("n"))
    numbers = [_number(p) for p in accepted(_counts(counted.collect()), at_least)]
    base = F.filter("spans", lambda s: s["strict"])
    extra = F.filter("spans", lambda s: ~s["strict"] & (s["number"].isin(*numbers) if numbers else F.lit(False)))
    rows = found.select("id", F.array_sort(base).alias("base"), extra.alias("extra"))
    free = F.filter(
        "extra",
        lambda s: ~F.exists("base", lambda b: (b["start"] < s["past"]) & (s["start"] < b["past"])),
    )
    return rows.select("id", "base", F.array_sort(F.concat("base", free)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return _joined(spans)
