"""Personal data by weak supervision, with DataFrame functions only.

Regular expressions propose candidate spans; five labelers (shape, checksum, gazetteer, cue and counter-cue in the
context) each vote for, against or not at all. The votes' patterns are counted in Spark; from the counts
expectation-maximisation estimates each labeler's reliability for each kind and every pattern's probability of
being personal data. These train the final classifier, a logistic regression over kind, votes, length and
neighbouring characters, whose weights become an expression. Spans of the base rules always stay.

All candidates are made in one pass over the texts and inside their rows; positions are code points. Patterns are
written so that no text makes the matcher go back over a run of characters or recurse.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagmill.llm.common import fresh, stored

KINDS = ("email", "ip", "card", "phone", "secret", "account", "person")
EMAIL, IP, CARD, PHONE, SECRET, ACCOUNT, PERSON = range(len(KINDS))
#: Kinds whose rules are exact; their spans stay whatever the classifier says.
BASE = KINDS[:4]
LABELERS = ("shape", "check", "gazetteer", "cue", "counter")
#: Added spans need this probability.
THRESHOLD = 0.5
#: Code points of context that the labelers see before and after a span.
BEFORE, AFTER = 40, 16
#: Values of which running sums are taken in one go.
STEP = 512
_AGAINST, _SILENT, _FOR = range(3)
#: Levels of the classifier's factors: kind, votes, length, characters before and after.
FACTORS = (len(KINDS), *[3] * len(LABELERS), 3, 3, 3)

_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_IP = rf"^{_PART}(?:\.{_PART}){{3}}$"
#: What proposes candidates. A match can only begin where a run of its characters does, or where the last match ended.
_FIND = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "digits": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+-])[A-Za-z0-9_+-]{16,}+",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
    "spelled": r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\)|\bat\b)\x20?[A-Za-z0-9-]{1,63}+\x20?(?:\[dot\]|\(dot\)|\bdot\b)\x20?[A-Za-z]{2,24}",
    "person": r"\b(?:Mrs?|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señora?|Sra?)\b\.?\x20\p{Lu}\p{Ll}{1,30}(?:\x20\p{Lu}\p{Ll}{1,30}){0,2}",
}
#: Fixed values of the gazetteers.
_TLDS = "com org net edu gov int info biz io eu de fr es it nl be at ch uk us ca mx br ar au jp cn in ru pl se no dk fi pt ie".split()
_COUNTRY_CODES = "1|7|20|27|3[0-4]|36|39|4[0134]|4[5-9]|5[1-8]|6[0-6]|8[1246]|9[0-5]|98|21[268]|35[1-9]|42[013]"
_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
_KEY_PREFIXES = r"^(?:sk[-_]|pk[-_]|ghp_|gho_|xox[abp]-|AKIA|ASIA|AIza|eyJ|glpat-)"
_IBAN_COUNTRIES = "AD AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IS IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK".split()
_GIVEN = "Alice Ana Andrea Anna Anne Antonio Carlos Carmen Charles Claire Daniel David Elena Emma Francisco Hans Henri Isabel Jacques James Jean John Jose Juan Julia Karl Klaus Laura Louis Luis Manuel Maria Marie Martin Mary Michael Miguel Nicolas Paul Peter Pierre Robert Sarah Sophie Stefan Susan Thomas Ursula William Wolfgang".split()
#: Words before a span that speak for it, by kind.
_CUES = (
    r"(?:e-?mail|mail|correo|courriel|contact|kontakt|contacto|@)\W{0,4}$|mailto:$",
    r"\b(?:ip|host|server|addr(?:ess)?|adresse|dirección|from|login)\W{0,4}$",
    r"\b(?:card|visa|mastercard|amex|karte|carte|tarjeta|kreditkarte)\b(?:\W+\p{L}+)?\W{0,4}$",
    r"\b(?:phone|tel|telefon|téléphone|teléfono|mobile|cell|fax|call|anruf)\b\W{0,4}$",
    r"(?:token|secret|passw(?:or)?d|pwd|api[_ -]?key|key|auth|bearer)[\"']?\s{0,3}[:=]?\s{0,3}[\"']?$",
    r"\b(?:iban|account|konto|compte|cuenta|ssn|social security)\b(?:\W+\p{L}+)?\W{0,4}$",
    r"\b(?:name|dear|signed|by|liebe[r]?|cher|chère|querid[oa]|estimad[oa])\W{0,4}$",
)
#: Words before a span that speak against any kind.
_COUNTER = r"(?:\b(?:v|ver|version|release|license|lizenz|licence|licencia|isbn|issn|doi|rfc|section|page|seite|order|invoice|sha-?[0-9]{1,3}|md5|commit|checksum|build)\b|§|©)\W{0,4}$"


def _running(values: str, out: str, merge: Callable[[Column, Column], Column], least: int) -> list[dict[str, Column]]:
    """Stages of columns: the running merge (sums, maxima) of an array of longs, each element included.

    Blocks of STEP elements first and then their ends, as an array that grows element by element is copied each time.
    """
    grow = lambda a, x: F.struct(merge(a.t, x).alias("t"), F.concat(a.out, F.array(merge(a.t, x))).alias("out"))
    start = lambda: F.struct(F.lit(least).cast("long").alias("t"), F.array().cast("array<bigint>").alias("out"))
    inner = lambda a: F.aggregate(a, start(), grow, lambda x: x.out)
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / STEP).cast("int")), lambda b: inner(F.slice(values, b * STEP + 1, STEP)))
    none = F.array().cast("array<array<bigint>>")
    parts, tops = f"{out}_parts", f"{out}_tops"
    carried = F.zip_with(F.col(parts), F.slice(F.concat(F.array(F.lit(least).cast("long")), tops), 1, F.size(tops)), lambda p, t: F.transform(p, lambda x: merge(t, x)))
    return [
        {parts: F.when(F.size(values) > 0, blocks).otherwise(none)},
        {tops: inner(F.transform(parts, lambda p: F.element_at(p, -1)))},
        {out: F.flatten(carried)},
    ]


def _matches(rows: DataFrame, text: str, guards: dict[str, Column]) -> tuple[DataFrame, dict[str, str]]:
    """`rows` with an array of (start, end, m, l, r) for each pattern: its matches, their places and contexts; and the arrays' names."""
    of = {k: fresh(f"of_{k}", rows.columns) for k in _FIND}
    none = F.array().cast("array<string>")
    # what lies between matches: its size, its end and its beginning
    between = lambda s: F.struct(F.length(s).cast("long").alias("n"), F.substring(s, -BEFORE, BEFORE).alias("l"), F.substring(s, 1, AFTER).alias("r"))
    sized = lambda p: lambda x, i: F.length(x) + F.get(p, i).n

    def found(c: str) -> Column:
        end, p = f"{c}_e", f"{c}_p"
        return F.transform(f"{c}_m", lambda x, i: F.struct((F.get(end, i) - F.length(x)).alias("start"), F.get(end, i).alias("end"), x.alias("m"), F.get(p, i).l.alias("l"), F.get(p, i + 1).r.alias("r")))

    out = rows.withColumns({f"{c}_m": F.when(guards.get(k, F.octet_length(text) > 0), F.regexp_extract_all(text, F.lit(_FIND[k]), 0)).otherwise(none) for k, c in of.items()})
    out = out.withColumns({f"{c}_p": F.transform(F.when(F.size(f"{c}_m") > 0, F.split(text, _FIND[k], -1)).otherwise(none), between) for k, c in of.items()})
    out = out.withColumns({f"{c}_n": F.transform(f"{c}_m", sized(f"{c}_p")) for c in of.values()})
    for stages in zip(*[_running(f"{c}_n", f"{c}_e", lambda a, b: a + b, 0) for c in of.values()]):
        out = out.withColumns(reduce(lambda a, b: a | b, stages))
    return out.select(*rows.columns, *[found(c).alias(c) for c in of.values()]), of


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def _candidate(x: Column, kind: Column, base: Column) -> Column:
    return F.struct(x.start.alias("start"), kind.cast("int").alias("kind"), x.end.alias("end"), base.alias("base"), x.m.alias("m"), F.lower(x.l).alias("l"), x.r.alias("r"))


def _by_kind(kind: Column, table: dict[int, Column]) -> Column:
    out = F.when(F.lit(False), F.lit(_SILENT))
    for k, v in table.items():
        out = out.when(kind == k, v)
    return out.otherwise(F.lit(_SILENT))


def _vote(yes: Column, no: Column | None = None) -> Column:
    out = F.when(yes, F.lit(_FOR))
    return (out if no is None else out.when(no, F.lit(_AGAINST))).otherwise(F.lit(_SILENT))


def _iban_rest(m: Column) -> Column:
    """The number behind an IBAN modulo 97."""
    bare = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.split(F.concat(F.substring(bare, 5, 64), F.substring(bare, 1, 4)), "")
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda a, c: (a * F.when(c.between("0", "9"), 10).otherwise(100) + value(c)) % 97)


def _votes(x: Column) -> list[Column]:
    """The labelers' votes on a candidate."""
    m, kind, digits = x.m, x.kind, _digits(x.m)
    like = lambda p: F.regexp_like(m, F.lit(p))
    dated = like(r"^(?:19|20)[0-9]{2}[\x20-]?[01][0-9][\x20-]?[0-3][0-9]")
    n = F.length(digits)
    distinct = F.size(F.array_distinct(F.split(F.substring(m, 1, 256), "")))
    iban = like("^[A-Z]")
    mixed = like("[A-Z]") & like("[a-z]") & like("[0-9]") & (F.length(m) >= 20)
    shape = {
        EMAIL: _vote(like(r"^[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,24}$"), ~F.contains(m, F.lit("@")) & ~like(r"[\[(]")),
        IP: _vote(like(_IP) & ~like(r"(?:^|\.)0[0-9]"), ~like(_IP)),
        CARD: _vote(like(r"^(?:[0-9]{14,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})$"), dated),
        PHONE: _vote(like(r"^\+") | like(r"^[0-9]{3}[\x20-][0-9]{3}[\x20-][0-9]{4}$"), dated | like("^[0-9]+$")),
        SECRET: _vote(like(r"^(?:[0-9a-f]{32}|[0-9A-F]{32}|[0-9a-f]{40}|[0-9A-F]{40}|[0-9a-f]{64}|[0-9A-F]{64})$") | mixed, like(r"[A-Za-z]{4,}[-_+][A-Za-z]{3,}") | like(r"(.)\1{7}")),
        ACCOUNT: _vote(like(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$") | iban),
        PERSON: _vote(like(r"\x20\p{Lu}\S+\x20\p{Lu}"), ~like(r"\x20\p{Lu}\S+\x20\p{Lu}")),
    }
    check = {
        EMAIL: _vote((F.length(m) <= 254) & (F.instr(m, "@") <= 65), F.length(m) > 254),
        IP: _vote(like(_IP), ~like(_IP)),
        CARD: _vote(_luhn(digits), ~_luhn(digits)),
        PHONE: _vote(like(r"^\+") & n.between(10, 15), like(r"^\+")),
        SECRET: _vote((distinct >= 10) & (n >= 3), distinct < 6),
        ACCOUNT: _vote(iban & (_iban_rest(m) == 1), iban | like(r"^(?:000|666|9)")),
        PERSON: F.lit(_SILENT),
    }
    gazetteer = {
        EMAIL: _vote(F.lower(F.regexp_extract(m, r"([A-Za-z]++)$", 1)).isin(_TLDS)),
        IP: _vote(F.lit(False), like(r"^(?:0|127|255)\.")),
        CARD: _vote(F.regexp_like(digits, F.lit(_ISSUERS))),
        PHONE: _vote(like(rf"^\+(?:{_COUNTRY_CODES})")),
        SECRET: _vote(like(_KEY_PREFIXES)),
        ACCOUNT: _vote(iban & F.substring(m, 1, 2).isin(_IBAN_COUNTRIES), iban),
        PERSON: _vote(like(r"\b(?:" + "|".join(_GIVEN) + r")\b")),
    }
    cue = {k: _vote(F.regexp_like(x.l, F.lit(p))) for k, p in enumerate(_CUES)}
    counter = _vote(F.lit(False), F.regexp_like(x.l, F.lit(_COUNTER)))
    return [_by_kind(kind, shape), _by_kind(kind, check), _by_kind(kind, gazetteer), _by_kind(kind, cue), counter]


def _code(x: Column) -> Column:
    """A candidate's levels of all factors as one number."""
    size = F.when(F.length(x.m) < 12, 0).when(F.length(x.m) <= 24, 1).otherwise(2)
    edge = lambda c, ends: F.when((c == "") | F.regexp_like(c, F.lit(ends)), 0).when(F.regexp_like(c, F.lit("[\"'(\\[<{>}\\])]")), 1).otherwise(2)
    levels = [x.kind, *_votes(x), size, edge(F.substring(x.l, -1, 1), r"\s"), edge(F.substring(x.r, 1, 1), r"[\s.,;:!?]")]
    return reduce(lambda a, z: a * z[0] + z[1], list(zip(FACTORS, levels))[1:], levels[0]).cast("int")


def levels_of(code: int) -> tuple[int, ...]:
    out = []
    for n in reversed(FACTORS):
        code, level = divmod(code, n)
        out.append(level)
    return tuple(reversed(out))


def mark(docs: DataFrame, text: str = "text", name: str = "candidates") -> DataFrame:
    """`docs` with an array of (start, kind, end, base, code): every base span and every other candidate of the text.

    In the order of start and kind. A candidate that is no base span goes if it overlaps one, or any candidate that
    starts before it. Null texts count as empty and get an empty array; texts are taken whole, their cost grows
    with their length; equal texts get equal arrays, an empty table gives none.
    """
    name, t = fresh(name, docs.columns), fresh("t", docs.columns)
    rows = docs.withColumn(t, F.coalesce(F.col(text), F.lit("")))
    has = lambda s: F.contains(t, F.lit(s))
    guards = {"email": has("@"), "phone": has("+"), "spelled": F.regexp_like(t, F.lit(r"(?i)\bdot\b"))}
    rows, of = _matches(rows, t, guards)
    rows = rows.drop(t)
    yes, no = F.lit(True), F.lit(False)

    def digits(x: Column) -> Column:
        d = _digits(x.m)
        card = F.length(d).between(14, 19)
        kind = F.when(F.regexp_like(x.m, F.lit(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$")), ACCOUNT).when(card, CARD).otherwise(PHONE)
        return _candidate(x, kind, card & _luhn(d))

    kept = {
        "email": F.transform(of["email"], lambda x: _candidate(x, F.lit(EMAIL), yes)),
        "ip": F.transform(of["ip"], lambda x: _candidate(x, F.lit(IP), F.regexp_like(x.m, F.lit(_IP)))),
        "digits": F.transform(F.filter(of["digits"], lambda x: F.length(_digits(x.m)).between(9, 19)), digits),
        "phone": F.transform(of["phone"], lambda x: _candidate(x, F.lit(PHONE), F.length(_digits(x.m)).between(10, 15))),
        "secret": F.transform(F.filter(of["secret"], lambda x: F.regexp_like(x.m, F.lit("[0-9]")) & F.regexp_like(x.m, F.lit("[A-Za-z]"))), lambda x: _candidate(x, F.lit(SECRET), no)),
        "iban": F.transform(of["iban"], lambda x: _candidate(x, F.lit(ACCOUNT), no)),
        "spelled": F.transform(of["spelled"], lambda x: _candidate(x, F.lit(EMAIL), no)),
        "person": F.transform(of["person"], lambda x: _candidate(x, F.lit(PERSON), no)),
    }
    rows = rows.select(*docs.columns, F.concat(*kept.values()).alias(name))
    coded = F.transform(name, lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.end.alias("end"), x.base.alias("base"), _code(x).alias("code")))
    rows = rows.withColumn(name, F.array_sort(coded))
    # the furthest end before each candidate, and the nearest base span's start after it
    far = (1 << 62) - 1
    ends, heads = fresh("ends", rows.columns), fresh("heads", rows.columns)
    rows = rows.withColumns({ends: F.transform(name, lambda x: x.end), heads: F.reverse(F.transform(name, lambda x: F.when(x.base, -x.start).otherwise(F.lit(-far))))})
    for one, two in zip(*[_running(c, f"{c}_run", F.greatest, -far) for c in (ends, heads)]):
        rows = rows.withColumns(one | two)
    before = lambda i: F.coalesce(F.get(f"{ends}_run", i - 1), F.lit(0))
    after = lambda i: -F.coalesce(F.get(f"{heads}_run", F.size(name) - i - 2), F.lit(-far))
    alone = F.filter(name, lambda x, i: x.base | ((before(i) <= x.start) & (after(i) >= x.end)))
    return rows.select(*docs.columns, alone.alias(name))


@dataclass
class Model:
    """Reliabilities by labeler, kind, truth and vote; the patterns' probabilities; weights by factor and level."""

    reliability: np.ndarray
    prior: np.ndarray
    posterior: dict[int, float]
    weights: list[list[float]]
    bias: float


#: Pseudo-counts of votes (against, silent, for) on what is personal data and what is not; a labeler errs seldom.
_BELIEF = np.array([[[9, 10, 1], [1, 7, 12]], [[12, 6, 2], [0.2, 5.8, 14]], [[6, 13, 1], [1, 13, 6]], [[6, 13, 1], [1, 12, 7]], [[8, 12, 0.1], [0.5, 19.4, 0.1]]], float)


def estimate(counts: dict[int, int], rounds: int = 100) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """Expectation-maximisation over the counts of patterns: reliabilities, priors of kinds, and posteriors by code.

    Labelers vote independently given the kind and the truth; _BELIEF, one true and three false candidates are added to the counts.
    A failed checksum is proof: else labelers that agree on numbers of the right shape would outvote it.
    """
    codes = sorted(counts)
    levels = np.array([levels_of(c) for c in codes], int).reshape(-1, len(FACTORS))
    n = np.array([counts[c] for c in codes], float)
    kind, votes = levels[:, 0], levels[:, 1 : 1 + len(LABELERS)]
    failed = votes[:, LABELERS.index("check")] == _AGAINST
    theta = np.repeat((_BELIEF / _BELIEF.sum(2, keepdims=True))[:, None], len(KINDS), axis=1)
    prior, p = np.full(len(KINDS), 0.5), np.zeros(len(codes))
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior))[kind]
        for j in range(len(LABELERS)):
            odds = odds + np.log(theta[j, kind, 1, votes[:, j]] / theta[j, kind, 0, votes[:, j]])
        p, old = np.where(failed, 0, 1 / (1 + np.exp(-odds))), p
        for truth, weight in ((0, n * (1 - p)), (1, n * p)):
            for j in range(len(LABELERS)):
                seen = np.bincount(kind * 3 + votes[:, j], weight, len(KINDS) * 3).reshape(-1, 3) + _BELIEF[j, truth]
                theta[j, :, truth] = seen / seen.sum(1, keepdims=True)
        prior = (np.bincount(kind, n * p, len(KINDS)) + 1) / (np.bincount(kind, n, len(KINDS)) + 4)
        if np.abs(p - old).max(initial=0) < 1e-9:
            break
    return theta, prior, dict(zip(codes, p.tolist()))


def fit(counts: dict[int, int], posterior: dict[int, float], ridge: float = 0.1, rounds: int = 50) -> tuple[list[list[float]], float]:
    """Weights by factor and level, and the bias, of a logistic regression on the posteriors as soft labels (Newton)."""
    codes = sorted(counts)
    offsets = np.cumsum([0, *FACTORS])
    x = np.zeros((len(codes), offsets[-1] + 1))
    x[:, -1] = 1
    for i, c in enumerate(codes):
        x[i, offsets[:-1] + levels_of(c)] = 1
    # many equal rows weigh as their root, so that rare patterns are learned too
    n = np.sqrt(np.array([counts[c] for c in codes], float))
    y, w = np.array([posterior[c] for c in codes]), np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (n * (y - p)) - ridge * w)
        w = w + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-10:
            break
    return [w[a:b].tolist() for a, b in zip(offsets, offsets[1:])], float(w[-1])


def learn(marked: DataFrame, name: str = "candidates") -> Model:
    """The model of a table that mark() made; the driver gets a row for each pattern, some 46,000 at the most."""
    # not explode(), whose filter for empty arrays Spark pushes below and repeats all stages of mark() in
    rows = marked.select(F.explode_outer(name).alias("x")).groupBy(F.col("x.code").alias("code")).count().collect()
    counts = {r["code"]: r["count"] for r in rows if r["code"] is not None}
    theta, prior, posterior = estimate(counts)
    return Model(theta, prior, posterior, *fit(counts, posterior))


def label(marked: DataFrame, model: Model, name: str = "candidates", spans: str = "spans") -> DataFrame:
    """`marked` with spans in place of the candidates: (kind, start, end, base, score), base ones and those of THRESHOLD or more."""
    spans = fresh(spans, [c for c in marked.columns if c != name])

    def score(code: Column) -> Column:
        total, below = F.lit(model.bias), math.prod(FACTORS)
        for n, own in zip(FACTORS, model.weights):
            below //= n
            total = total + F.get(F.array(*[F.lit(w) for w in own]), F.floor(code / below).cast("int") % n)
        return 1 / (1 + F.exp(-total))

    kinds = F.array(*[F.lit(k) for k in KINDS])
    scored = F.transform(name, lambda x: F.struct(F.get(kinds, x.kind).alias("kind"), x.start.alias("start"), x.end.alias("end"), x.base.alias("base"), score(x.code).alias("score")))
    out = marked.withColumn(name, scored)
    return out.select(*[c for c in out.columns if c != name], F.filter(name, lambda x: x.base | (x.score >= THRESHOLD)).alias(spans))


def find_pii(docs: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """`docs` with the personal data of each text as an array of (kind, start, end, base, score); code points, end exclusive.

    Learned from all rows, in a pass over them before the one that finds. Null and empty texts have none; texts
    are taken whole; repeated rows get equal spans and count each in learning; an empty table gives none. A
    column of the name `spans` stays, and the new one gets a leading underscore. Write the result before filtering
    on it: Spark moves such a filter below and repeats the work.
    """
    marked = mark(docs, text)
    name = marked.columns[-1]
    return label(marked, learn(marked, name), name, spans)


def _told(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and all spans of every document."""
    marked = stored(mark(docs.select("doc_id", "text")).drop("text"), "candidates")
    found = label(marked, learn(marked))
    base = F.filter("spans", lambda x: x.base)
    count = lambda k: F.size(F.filter("spans", lambda x: x.base & (x.kind == k))).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(count, BASE), F.sha2(_told(base).cast("binary"), 256).alias("base_sha256"), _told(F.col("spans")).alias("spans"))
