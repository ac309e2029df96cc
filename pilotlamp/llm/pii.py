"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans. Four labelers (pattern, gazetteer, context, boundary) vote +, - or 0 on each; expectation-maximisation
over the counts of vote patterns estimates how reliable each labeler is and how likely each pattern is a true span; these
soft labels train a naive Bayes classifier over features of the spans, which decides on the spans that are not base ones.
Base spans (email, ip, card, phone that pass their checks) always stay.

Null texts read as empty and have no spans. Repeated rows are judged one by one. Positions are code points, the end is
exclusive. Columns of the input pass through; one named like a result is replaced. A table without spans gives none.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pilotlamp.llm.common import col, without
from pilotlamp.session import durable

BASE = ["email", "ip", "card", "phone"]
ADDED = ["secret", "local_phone"]
KINDS = BASE + ADDED
ROUNDS = 50
BLOCK = 128  # matches of a text that are copied when one is added

# Word lists of the gazetteer and of the context labeler
DOMAINS = ["com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu"]
CALLING_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "52", "55", "61", "81", "82", "86", "90", "91"]
KEY_MARKS = ["sk_", "sk-", "pk_", "ghp_", "xox", "AKIA", "eyJ"]
CUES = {
    "email": "mail|contact|write to|schreib|courriel|correo",
    "ip": "ip|host|server|address|addr|login",
    "card": "card|visa|credit|pay|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax",
    "secret": "token|secret|passw|api.?key|access.?key|auth|credential",
    "local_phone": "phone|tel|call|mobile|fax",
}
AGAINST = "version|section|isbn|order|sha|md5|commit|invoice|article|page|fig"

LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    # a run that fails at its first place fails at all of them; \G is where the last match ended; a group that repeats with
    # nothing after it is possessive, for others are matched by recursion and a long run would exhaust the stack
    "email": f"(?:(?<![{LOCAL}])|\\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
    "ip": "(?:(?<![0-9])|\\G)[0-9]++(?:\\.[0-9]++){3}",
    "card": "[0-9](?:[\\x20-]?[0-9])++",
    "phone": "\\+[0-9][\\x20().0-9-]+[0-9]",
    "secret": "(?<![A-Za-z0-9_-])[A-Za-z0-9_-]{20,}+",
    "local_phone": "(?<![0-9A-Za-z])\\(?[0-9]{3}\\)?[\\x20.-]{1,2}[0-9]{3}[\\x20.-][0-9]{4}(?![0-9A-Za-z])",
}
OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

Span = "struct<kind:string,start:int,end:int,base:boolean,votes:string,features:array<string>>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def doubled(x, i):
        d = x.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    worth = F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)), doubled)
    return F.aggregate(worth, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: str, hit: Column) -> Column:
    n = F.length(_digits(hit))
    return {
        "email": F.lit(True),
        "ip": hit.rlike(f"^{OCTET}(?:\\.{OCTET}){{3}}$"),
        "card": n.between(13, 19) & _luhn(_digits(hit)),
        "phone": n.between(9, 15),
        "secret": hit.rlike("[0-9]") & hit.rlike("[A-Za-z]"),
        "local_phone": F.lit(True),
    }[kind]


def _sign(good: Column, bad: Column) -> Column:
    return F.when(good, "+").when(bad, "-").otherwise("0")


def _votes(kind: str, hit: Column, before: Column, after: Column) -> Column:
    """One character for each labeler."""
    digits, never = _digits(hit), F.lit(False)
    pattern = {
        "secret": _sign(hit.rlike("^[0-9a-fA-F]{32,}$|^[A-Za-z0-9_-]{40,}$"), hit.rlike("[-_].*[-_].*[-_]")),
        "local_phone": _sign(hit.rlike("^\\([0-9]{3}\\) |-"), hit.rlike("^[0-9.]+$")),
    }.get(kind, F.lit("+"))
    gazetteer = {
        "email": _sign(F.regexp_extract(hit, "([A-Za-z]+)$", 1).isin(DOMAINS), never),
        "ip": _sign(hit.rlike("^(?!0|127\\.|22[4-9]|2[3-5])[0-9]"), hit.rlike("^(?:0|127)\\.")),
        "card": _sign(digits.rlike("^[3-6]"), digits.rlike("^0")),
        "phone": _sign(digits.rlike("^(?:" + "|".join(CALLING_CODES) + ")"), digits.rlike("^0")),
        "secret": _sign(hit.rlike("^(?:" + "|".join(KEY_MARKS) + ")"), never),
        "local_phone": _sign(digits.rlike("^[2-9][0-9]{2}[2-9]"), digits.rlike("^[01]")),
    }[kind]
    context = _sign(before.rlike(f"(?i)(?:{CUES[kind]})"), before.rlike(f"(?i)(?:{AGAINST})\\W*$"))
    edge = _sign(before.rlike("(?:^|[\\s\"'(:=<>,;|])$") & after.rlike("^(?:$|[^0-9A-Za-z@_])"), after.rlike("^[0-9A-Za-z@_]"))
    return F.concat(pattern, gazetteer, context, edge)


def _features(kind: str, hit: Column, before: Column, after: Column) -> Column:
    n, figures = F.length(hit), F.length(_digits(hit))
    known = {
        "length": F.least(F.floor(F.log2(n + 1)), F.lit(8)),
        "figures": F.floor(4 * figures / F.greatest(n, F.lit(1))),
        "before": F.when(before.rlike("[\"'=:]\\s*$"), "sign").when(before.rlike("\\s$|^$"), "blank").otherwise("other"),
        "after": F.when(after.rlike("^[\"']"), "quote").when(after.rlike("^\\s|^$"), "blank").when(after.rlike("^\\w"), "word").otherwise("other"),
        "cue": before.rlike(f"(?i)(?:{CUES[kind]})"),
    }
    return F.array(*[F.concat(F.lit(f"{kind}.{name}."), value.cast("string")) for name, value in known.items()])


def _listed_in_order(items: Column, step, kind: str, finish) -> Column:
    """What ``step(at, item)`` adds for each item, beside the new ``at``; ``finish(at, list)`` ends it.

    The list grows in blocks: appending copies one block, not all that was found before.
    """
    none = F.expr(f"cast(array() as array<{kind}>)")
    start = F.struct(F.lit(0).alias("at"), none.alias("block"), F.expr(f"cast(array() as array<array<{kind}>>)").alias("full"))

    def add(acc, x):
        at, one = step(acc["at"], x)
        full = F.size(acc["block"]) == BLOCK
        block = F.when(full, F.array(one)).otherwise(F.concat(acc["block"], F.array(one)))
        return F.struct(at.alias("at"), block.alias("block"), F.when(full, F.concat(acc["full"], F.array(acc["block"]))).otherwise(acc["full"]).alias("full"))

    return F.aggregate(items, start, add, lambda acc: finish(acc["at"], F.concat(F.flatten(acc["full"]), acc["block"])))


def _found(kind: str, text: Column) -> Column:
    """Spans of a kind from the gaps and matches of one chain of searches, each beginning where the last match ended."""
    chain = F.lit(f"(?s)\\G(.*?)({PATTERNS[kind]})")
    pairs = F.arrays_zip(
        F.regexp_extract_all(text, chain, F.lit(1)).alias("gap"), F.regexp_extract_all(text, chain, F.lit(2)).alias("hit")
    )

    def step(at, x):
        begin = at + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        return end, F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("hit"))

    return _listed_in_order(pairs, step, "struct<start:int,end:int,hit:string>", lambda at, out: out)


def _described(kind: str, text: Column, found: Column) -> Column:
    def span(m):
        before = F.substr(text, F.greatest(m["start"] - 39, F.lit(1)), F.least(m["start"], F.lit(40)))
        after = F.substr(text, m["end"] + 1, F.lit(2))
        return F.struct(
            F.lit(kind).alias("kind"), m["start"].alias("start"), m["end"].alias("end"), F.lit(kind in BASE).alias("base"),
            _votes(kind, m["hit"], before, after).alias("votes"), _features(kind, m["hit"], before, after).alias("features"),
        )

    return F.transform(F.filter(found, lambda m: _passes(kind, m["hit"])), span).cast(f"array<{Span}>")


def propose(documents: DataFrame, keep=None) -> DataFrame:
    """``documents`` with ``candidates``: all spans the patterns propose, with votes and features, in order.

    A proposed span that overlaps a base span, or one of an earlier kind, is left out.
    """
    kept = without(documents.columns if keep is None else keep, ["candidates"])
    text = F.coalesce(F.col("text"), F.lit(""))
    figures = F.col("_text").rlike("[0-9]")
    worth = {
        "email": F.contains("_text", F.lit("@")), "ip": figures, "card": figures, "phone": F.contains("_text", F.lit("+")),
        "secret": figures, "local_phone": figures,
    }
    none = F.expr("cast(array() as array<struct<start:int,end:int,hit:string>>)")
    out = documents.select(*[col(c).alias(f"c{i}") for i, c in enumerate(kept)], text.alias("_text"))
    out = out.select("*", *[F.when(worth[k], _found(k, F.col("_text"))).otherwise(none).alias(f"_{k}") for k in KINDS])
    out = out.select("*", *[_described(k, F.col("_text"), F.col(f"_{k}")).alias(f"_d{k}") for k in KINDS])

    def apart(spans, taken):
        return F.filter(spans, lambda s: ~F.exists(taken, lambda o: (s["start"] < o["end"]) & (o["start"] < s["end"])))

    taken = F.concat(*[F.col(f"_d{k}") for k in BASE])
    for k in ADDED:
        taken = F.concat(taken, apart(F.col(f"_d{k}"), taken))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], taken.alias("candidates"))


def fit_votes(counts: dict[tuple[str, str], int]) -> tuple[dict[tuple[str, str], float], dict]:
    """Expectation-maximisation: probability that spans of a kind with given votes are true, and the reliabilities.

    The input has one entry for each kind and vote pattern, 81 a kind at most.
    """
    signs = "+0-"
    trust = [{True: dict(zip(signs, (6.0, 3.0, 1.0))), False: dict(zip(signs, (1.0, 3.0, 6.0)))} for _ in range(4)]
    says = [{y: {v: n / 10 for v, n in t[y].items()} for y in t} for t in trust]
    prior, posterior = dict.fromkeys(KINDS, 0.5), {}
    for _ in range(ROUNDS):
        for (kind, votes), _n in counts.items():
            yes, no = prior[kind], 1 - prior[kind]
            for says_i, v in zip(says, votes, strict=True):
                yes, no = yes * says_i[True][v], no * says_i[False][v]
            posterior[kind, votes] = yes / (yes + no)
        for kind in KINDS:
            own = [(n, posterior[kv]) for kv, n in counts.items() if kv[0] == kind]
            prior[kind] = (1 + sum(n * p for n, p in own)) / (2 + sum(n for n, _ in own))
        for i, t in enumerate(trust):
            for y in t:
                mass = dict(t[y])  # the expectation that a labeler is better than chance, as pseudo-counts
                for kv, n in counts.items():
                    mass[kv[1][i]] += n * (posterior[kv] if y else 1 - posterior[kv])
                says[i][y] = {v: m / sum(mass.values()) for v, m in mass.items()}
    return posterior, {"prior": prior, "labelers": says}


def _lookup(values: dict[str, float], key: Column) -> Column:
    pairs = [F.lit(x) for kv in sorted(values.items()) for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(0.0)) if pairs else F.lit(0.0)


def find(documents: DataFrame, keep=None) -> DataFrame:
    """``documents`` with ``spans``: the base spans and those the classifier accepts, by kind as listed, then start."""
    kept = without(documents.columns if keep is None else keep, ["spans"])
    known = durable(propose(documents, kept))
    span = known.select(F.explode("candidates").alias("s")).select("s.kind", "s.votes", "s.features")
    counts = {(r["kind"], r["votes"]): r["count"] for r in span.groupBy("kind", "votes").count().collect()}
    posterior, _ = fit_votes(counts)
    soft = _lookup({f"{k}{v}": p for (k, v), p in posterior.items()}, F.concat("kind", "votes"))
    # naive Bayes over features: a bounded table, a few values for each of the kinds
    sums = {
        r["feature"]: (r["yes"], r["no"])
        for r in span.select(F.explode("features").alias("feature"), soft.alias("p")).groupBy("feature")
        .agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    }
    whole = {}
    for name, (yes, no) in sums.items():
        kind = name.split(".")[0]
        if name.startswith(f"{kind}.length."):
            a, b = whole.get(kind, (1.0, 1.0))
            whole[kind] = a + yes, b + no
    odds = {k: math.log(a / b) for k, (a, b) in whole.items()}
    weight = {}
    for name, (yes, no) in sums.items():
        a, b = whole[name.split(".")[0]]
        weight[name] = math.log((yes + 1) / (a + 4)) - math.log((no + 1) / (b + 4))

    def accepted(s):
        total = F.aggregate(s["features"], _lookup(odds, s["kind"]), lambda a, f: a + _lookup(weight, f))
        return s["base"] | (total >= 0)

    order = F.array(*[F.lit(k) for k in KINDS])
    place = F.transform(F.filter("candidates", accepted), lambda s: F.struct(
        F.array_position(order, s["kind"]).cast("int").alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base")
    ))
    spans = F.transform(F.array_sort(place), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")))
    return known.select(*map(col, kept), spans.alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the result of ``find``."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return found.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(_listed(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )


def redact(documents: DataFrame) -> DataFrame:
    """``documents`` with every span of ``text`` replaced by its kind in angle brackets; overlapping spans are joined."""
    found = find(documents)
    by_place = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def step(at, s):
        gap = F.substr(F.col("text"), at + 1, s["start"] - at)
        return F.greatest(at, s["end"]), F.when(s["start"] < at, "").otherwise(F.concat(gap, F.lit("<"), F.upper(s["kind"]), F.lit(">")))

    whole = _listed_in_order(by_place, step, "string", lambda at, out: F.concat(F.array_join(out, ""), F.substr(F.col("text"), at + 1, F.length("text"))))
    return found.withColumn("text", F.when(F.size("spans") > 0, whole).otherwise(F.col("text"))).select(*map(col, without(documents.columns, ["spans"])))
