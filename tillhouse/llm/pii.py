"""Operator 5: personal data by weak supervision [native].

Candidate spans come from patterns.  Four kinds have a fixed definition and
always stay (email, ip, card, phone); the method adds spans of further kinds
(``EXTRA``).  Each candidate gets votes from labelers: the pattern's own
checks, gazetteers (known endings, prefixes, code lists) and the words before
it.  Expectation-maximisation estimates each labeler's reliability per latent
class and each candidate's probability of being personal data; a logistic span
classifier then learns these soft labels from the span's features and decides
about the added spans.

Everything on rows is DataFrame functions.  Training sees one small table: the
number of candidates for each (kind, votes, features) combination, at most
``len(KINDS) * 3 ** 4 * FEATURE_VALUES`` rows however large the corpus; its
counts cover all documents.

Spans are found per text with ``split`` and ``regexp_extract_all``: the
lengths of the pieces between matches give the places, in code points.  The
patterns are written so that Java's matcher finds the leftmost match in linear
time: possessive runs that start only where a run starts.

Defined results: null is the empty text (no spans, the digest of nothing);
rows are independent, so repeated rows and ids each get their own result; no
candidates: nothing is added; an empty table gives an empty one; very long texts
are read whole; other columns are passed through under any name, but those named
like an output column, which it replaces.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.llm.common import at, numbered, running

BASE_KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # added kinds
    "local_phone": r"(?<![0-9+)(.-])(?<![0-9][\x20])\(?[0-9]{3,5}\)?[\x20.-][0-9]{3,4}(?:[\x20.-][0-9]{2,4}){1,2}(?![0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{20,}+={0,2}",
    "masked_email": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]++\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]++(?:(?:\x20?[\[(]dot[\])]\x20?|\.)[A-Za-z0-9-]++)++",
}
EXTRA = tuple(k for k in PATTERNS if k not in BASE_KINDS)
KINDS = tuple(PATTERNS)
#: A text without this can't match (cheap test before the pattern).
NEEDS = {"email": "@", "phone": "+", "national_id": "-", "masked_email": "at"}

#: Gazetteers (fixed values).
DOMAIN_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "eu", "uk", "us", "ch", "at", "it", "nl", "example")
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "86", "91")
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36")
KEY_PREFIXES = ("sk_", "sk-", "pk_", "ghp_", "gho_", "AKIA", "xox", "eyJ", "AIza", "glpat-")
IBAN_COUNTRIES = ("DE", "FR", "ES", "GB", "IT", "NL", "BE", "CH", "AT", "PT", "PL", "IE")
CUES = {
    "email": r"mail|contact|kontakt|courriel|correo|write", "masked_email": r"mail|contact|kontakt|courriel|correo|write",
    "ip": r"\bip\b|host|server|address|client|login", "card": r"card|karte|carte|tarjeta|visa|credit|pay",
    "phone": r"phone|tel|call|fax|mobil|anruf|llam|appel", "local_phone": r"phone|tel|call|fax|mobil|anruf|llam|appel",
    "national_id": r"ssn|social|\bid\b|insurance|passport", "iban": r"iban|bank|konto|account|compte|cuenta",
    "secret": r"token|secret|passw|pwd|api|key|credential|auth",
}
NEGATIVE_CUES = r"version|isbn|chapter|figure|page|sha|md5|commit|total|serial|http"
BEFORE = 24  # code points of context


# ---- places -----------------------------------------------------------------
def _sums(lengths: Column) -> Column:
    return running(lengths, lambda a, b: a + b, F.lit(0).cast("long"))


def _matches(t: Column, kind: str) -> tuple[Column, Column]:
    some = t.contains(NEEDS[kind]) if kind in NEEDS else t.rlike("[0-9]") if kind != "secret" else F.lit(True)
    none = F.array().cast("array<string>")
    return (F.when(some, F.regexp_extract_all(t, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(none),
            F.when(some, F.split(t, PATTERNS[kind], -1)).otherwise(none))


SPAN = "array<struct<kind:int,start:bigint,end:bigint,value:string>>"


def _spans(kind: str) -> Column:
    """Spans of one kind from its arrays of matches and of pieces between them."""
    m, p = F.col(f"_m_{kind}"), F.col(f"_p_{kind}")
    steps = F.transform(m, lambda v, i: (F.length(F.get(p, i)) + F.length(v)).cast("long"))
    return F.when(F.size(m) > 0, F.transform(
        F.arrays_zip(m.alias("v"), _sums(steps).alias("e")),
        lambda z: F.struct(F.lit(KINDS.index(kind)).alias("kind"), (z["e"] - F.length(z["v"])).alias("start"),
                           z["e"].alias("end"), z["v"].alias("value")))).otherwise(F.array().cast(SPAN))


# ---- checks that belong to a kind -------------------------------------------
def luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(acc, i):
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return acc + F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))
    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        return v.rlike(r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$")
    if kind == "card":
        return F.length(digits).between(16, 19) & F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(8, 15)
    if kind == "secret":
        return v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    if kind == "local_phone":
        return F.length(digits).between(9, 12)
    if kind == "national_id":
        return ~v.rlike(r"^(?:000|666|9)|-00-|-0000$")
    return F.lit(True)


def listed(kind: str, v: Column) -> Column:
    """The gazetteers' opinion: -1, 0 or 1."""
    vote = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    if kind in ("email", "masked_email"):
        return vote(F.lower(F.regexp_extract(v, r"([A-Za-z]+)$", 1)).isin(*DOMAIN_ENDINGS), v.rlike(r"[0-9]$"))
    if kind == "phone":
        return vote(F.lit(False) | v.rlike(r"^\+(?:" + "|".join(CALLING_CODES) + ")"))
    if kind == "card":
        return vote(v.rlike("^(?:" + "|".join(CARD_PREFIXES) + ")"), v.rlike("^[07-9]"))
    if kind == "ip":
        return vote(~v.rlike(r"^(?:0|127|255)\."), v.rlike(r"^0\."))
    if kind == "secret":
        return vote(v.rlike("^(?:" + "|".join(KEY_PREFIXES) + ")") | v.rlike(r"^(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"), ~v.rlike("[0-9].*[0-9]"))
    if kind == "iban":
        return vote(F.substring(v, 1, 2).isin(*IBAN_COUNTRIES), ~F.substring(v, 1, 2).isin(*IBAN_COUNTRIES))
    return F.lit(0)


FEATURE_VALUES = 4 * 4 * 3 * 2 * 2
VOTES = ("v1", "v2", "v3", "v4")
FEATURES = ("f_size", "f_digits", "f_left", "f_assigned", "f_upper")


def facts(s: Column, t: Column, kinds=KINDS) -> dict[str, Column]:
    """Kind, votes and features of a span ``s`` of text ``t``: the kind's own
    check, the gazetteers, cue words before the span, words that speak against
    it; size, share of digits, the character before, an assignment sign, capitals."""
    v, kind = s["value"], s["kind"]
    ctx = F.lower(F.substring(t, F.greatest(F.lit(1), s["start"] - BEFORE + 1).cast("int"),
                              F.least(F.lit(BEFORE), s["start"]).cast("int")))
    by = lambda of: F.coalesce(*[F.when(kind == KINDS.index(k), of(k)) for k in kinds], F.lit(0))
    n, digits, last = F.length(v), F.length(F.regexp_replace(v, "[^0-9]", "")), F.substring(ctx, -1, 1)
    return {
        "kind": kind, "v1": by(lambda k: F.when(valid(k, v), 1).otherwise(-1)), "v2": by(lambda k: listed(k, v)),
        "v3": by(lambda k: F.when(ctx.rlike(CUES[k]), 1).otherwise(0)), "v4": F.when(ctx.rlike(NEGATIVE_CUES), -1).otherwise(0),
        "f_size": F.least(F.floor(n / 10), F.lit(3)).cast("int"), "f_digits": F.floor(F.least(3 * digits / n, F.lit(3))).cast("int"),
        "f_left": F.when(last.isin("", " ", "\n"), 0).when(last.rlike("[A-Za-z0-9]"), 1).otherwise(2),
        "f_assigned": ctx.rlike("[:=]").cast("int"), "f_upper": v.rlike("[A-Z]").cast("int"),
    }


# ---- training on the table of counts ----------------------------------------
def estimate(rows: list[dict], rounds: int = 40) -> list[float]:
    """Expectation-maximisation: P(personal) of each combination.  A labeler's
    chance of each vote given the class is shared by all kinds; the share of
    personal data is estimated per kind."""
    p = [min(0.95, max(0.05, 0.5 + 0.2 * sum(r[v] for v in VOTES))) for r in rows]
    for _ in range(rounds):
        share, says = {}, {}
        for r, q in zip(rows, p):
            a, b = share.get(r["kind"], (1.0, 1.0))
            share[r["kind"]] = (a + q * r["n"], b + (1 - q) * r["n"])
            for v in VOTES:
                for c, w in ((1, q), (0, 1 - q)):
                    says[v, r[v], c] = says.get((v, r[v], c), 1.0) + w * r["n"]
        whole = {(v, c): sum(says.get((v, x, c), 1.0) for x in (-1, 0, 1)) for v in VOTES for c in (0, 1)}
        for i, r in enumerate(rows):
            a, b = share[r["kind"]]
            odds = math.log(a / b) + sum(math.log(says.get((v, r[v], 1), 1.0) / whole[v, 1])
                                         - math.log(says.get((v, r[v], 0), 1.0) / whole[v, 0]) for v in VOTES)
            p[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return p


def _inputs(r: dict) -> list[str]:
    return ["1", f"kind={r['kind']}", *[f"{v}={r[v]}" for v in VOTES], *[f"{f}={r[f]}" for f in FEATURES]]


def fit(rows: list[dict], p: list[float], rounds: int = 300, rate: float = 0.5) -> dict[str, float]:
    """Logistic regression on the soft labels, by gradient steps over the table."""
    w: dict[str, float] = {}
    total = sum(math.log1p(r["n"]) for r in rows) or 1.0
    for _ in range(rounds):
        g: dict[str, float] = {}
        for r, q in zip(rows, p):
            xs = _inputs(r)
            s = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(w.get(x, 0.0) for x in xs)))))
            for x in xs:
                g[x] = g.get(x, 0.0) + math.log1p(r["n"]) * (q - s) / total
        for x, d in g.items():
            w[x] = w.get(x, 0.0) + rate * (d - 0.001 * w.get(x, 0.0)) * 4
    return w


# ---- the operator -----------------------------------------------------------
def with_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` plus ``base`` and ``extra`` arrays of spans (candidates only)."""
    out = df.withColumn("_t", F.coalesce(F.col(text), F.lit("")))
    found = {k: _matches(F.col("_t"), k) for k in KINDS}
    out = out.select("*", *[c.alias(f"_{x}_{k}") for k, ms in found.items() for x, c in zip("mp", ms)])
    out = out.select(*df.columns, "_t", *[_spans(k).alias(f"_s_{k}") for k in KINDS])
    keep = lambda k: F.filter(f"_s_{k}", lambda s: valid(k, s["value"]))
    return out.select(*df.columns, "_t", F.concat(*[keep(k) for k in BASE_KINDS]).alias("base"),
                      F.concat(*[F.col(f"_s_{k}") for k in EXTRA]).alias("extra"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def train(df: DataFrame, text: str = "text") -> dict[str, float]:
    """Weights of the span classifier from all candidates of ``df``."""
    spans = with_spans(df.select(F.col(text).alias("text")), "text").select(
        "_t", F.explode(F.concat("base", "extra")).alias("c"))
    counts = (spans.select(*[c.alias(k) for k, c in facts(F.col("c"), F.col("_t")).items()])
                   .groupBy("kind", *VOTES, *FEATURES).agg(F.count("*").alias("n")))
    rows = sorted((r.asDict() for r in counts.collect()), key=lambda r: tuple(r.values()))  # bounded by the value ranges
    return fit(rows, estimate(rows))


def find_pii(df: DataFrame, weights: dict[str, float], text: str = "text", least: float = 0.5) -> DataFrame:
    """``df`` plus n_<kind> of the base kinds, n_added, base_sha256, and spans:
    all spans as kind:start:end, by kind, then start."""
    own = [*[f"n_{k}" for k in BASE_KINDS], "n_added", "base_sha256", "spans"]
    found = with_spans(numbered(df), at(df, text))
    # the classifier as one expression on a candidate, inside the row
    kept = found.withColumn("added", F.filter("extra", lambda s: _accepted(s, weights, least)))
    size = lambda c: F.size(c).cast("long")
    return kept.select(
        *[F.col(at(df, c)).alias(c) for c in df.columns if c not in own],
        *[size(F.filter("base", _is(i))).alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)],
        size("added").alias("n_added"), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"))


def _is(i: int):
    return lambda s: s["kind"] == i


def _accepted(s: Column, weights: dict[str, float], least: float) -> Column:
    """Whether the classifier takes a span of the row, as one expression."""
    value = facts(s, F.col("_t"), EXTRA)
    logit = F.lit(weights.get("1", 0.0))
    for name, col in value.items():
        pairs = [(int(x.split("=")[1]), w) for x, w in weights.items() if x.startswith(name + "=")]
        if pairs:
            logit = logit + F.coalesce(*[F.when(col == i, w) for i, w in pairs], F.lit(0.0))
    return logit >= math.log(least / (1 - least))
