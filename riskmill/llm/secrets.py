"""Secret scans over a trigram inverted index, in DataFrame functions only.

Every rule is a regular expression. Its Boolean trigram query is derived from its syntax tree: which
trigrams must a text hold to match at all. The index has a posting (trigram, doc_id)
for each trigram that any rule asks for; a clause's postings are intersected by counting, and
only the documents left are matched against the expression itself. A rule without a mandatory
trigram scans every text.
"""

from __future__ import annotations

import re._constants as kinds
import re._parser as syntax
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame, functions as F

from riskmill.llm.common import let, plain, text_or_empty, unused


@dataclass(frozen=True)
class Rule:
    """``kind``, expression, and the fewest characters of ``group`` that make a match count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The three base kinds in their order. Runs of hex digits are taken whole, so asking for
#: 24 of them in the expression drops the same runs as asking afterwards.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
#: Formats of well-known credentials, reported beside the base kinds.
ADDED = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("git_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + ADDED
#: Strings that an expression's part is expanded to, at most, before it is taken as unknown.
MAX_STRINGS = 64

Clauses = frozenset[frozenset[str]]  # any of the sets, each with all of its trigrams
ANYTHING: Clauses = frozenset([frozenset()])


def _both(a: Clauses, b: Clauses) -> Clauses:
    return _minimal(x | y for x, y in product(a, b))


def _minimal(clauses) -> Clauses:
    found = set(clauses)
    return frozenset(c for c in found if not any(o < c for o in found))


def _of_strings(strings: set[str]) -> Clauses:
    return _minimal(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _sequence(items) -> tuple[set[str] | None, Clauses]:
    """(all strings it can be, if few, else None; trigrams it must hold)."""
    strings, query, exact = {""}, ANYTHING, True
    for item in items:
        some, need = _node(*item)
        if some is not None and len(some) * len(strings) <= MAX_STRINGS:
            strings = {a + b for a, b in product(strings, some)}
        else:
            query = _both(query, _both(_of_strings(strings), need))
            strings, exact = {""}, False
    query = _both(query, _of_strings(strings))
    return (strings if exact else None), query


def _node(kind, value) -> tuple[set[str] | None, Clauses]:
    if kind is kinds.LITERAL:
        return {chr(value).lower()}, ANYTHING
    if kind is kinds.IN and all(k is kinds.LITERAL for k, _ in value):
        return {chr(v).lower() for _, v in value}, ANYTHING
    if kind is kinds.SUBPATTERN:
        return _sequence(value[-1])
    if kind is kinds.BRANCH:
        parts = [_sequence(p) for p in value[1]]
        strings = None
        if all(s is not None for s, _ in parts):
            strings = set().union(*(s for s, _ in parts))
        return strings, _minimal(c for _, q in parts for c in q)
    if kind in (kinds.MAX_REPEAT, kinds.MIN_REPEAT):
        low, high, body = value
        strings, query = _sequence(body)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ANYTHING
        if low == high == 1:
            return strings, query
        return None, query if low else ANYTHING
    return None, ANYTHING


def trigram_query(pattern: str) -> Clauses:
    """Clauses of lower-case trigrams: every match lies in a text that holds all of some clause.

    ``{frozenset()}`` means that the expression has no mandatory trigram.
    """
    clauses = _sequence(syntax.parse(pattern))[1]
    return ANYTHING if any(not c for c in clauses) else clauses


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id) for every document and each of ``trigrams`` in its lower-case text."""
    found = let(
        F.lower(text_or_empty()),
        lambda low: F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams))),
    )
    return plain(docs, "doc_id", "text").select(F.explode(found).alias("trigram"), "doc_id")


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, kinds): rules whose trigram query the document meets; scanned rules are left out."""
    spark = docs.sparkSession
    rows = [
        (rule.kind, f"{rule.kind}/{n}", trigram, len(clause))
        for rule in rules
        for n, clause in enumerate(sorted(trigram_query(rule.pattern), key=sorted))
        for trigram in sorted(clause)
    ]
    clauses = spark.createDataFrame(rows, "kind string, clause string, trigram string, needed int")
    index = postings(docs, sorted({r[2] for r in rows}))
    met = index.distinct().join(F.broadcast(clauses), "trigram").groupBy("doc_id", "kind", "clause", "needed")
    full = met.agg(F.count("*").alias("n")).filter("n = needed")
    return full.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))




def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, place, end, kind): non-overlapping matches from the left, too short ones dropped.

    Splitting at the matches gives what lies between them, so the lengths of both add up
    to code-point positions.
    """
    pattern = F.lit(rule.pattern)
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    steps = F.arrays_zip(
        F.transform(F.slice(between, 1, F.size(found)), F.char_length).alias("gap"),
        F.transform(found, F.char_length).alias("long"),
        F.transform(value, F.char_length).alias("value"),
    )
    empty = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(state, match):
        begin = state["at"] + match["gap"]
        span = F.struct(begin.alias("start"), F.lit(order).alias("place"), (begin + match["long"]).alias("end"),
                        F.lit(rule.kind).alias("kind"))
        spans = F.when(match["value"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((begin + match["long"]).alias("at"), spans.alias("spans"))

    return F.aggregate(steps, start, step, lambda state: state["spans"])


def with_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and its name: the spans of all rules by start, then rule order.

    Null texts are empty. Texts with a null or repeated doc_id are scanned like others. Rows stay as many as
    they are; overlapping spans of different rules all stay. Texts are dealt out once, beside their kinds.
    """
    own, kinds, spans = unused(docs, 3)
    marked = candidates(docs, rules).select(F.col("doc_id").alias(own), F.col("kinds").alias(kinds))
    joined = docs.join(marked, F.col("doc_id").eqNullSafe(F.col(own)), "left")
    empty = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    found = []
    for order, rule in enumerate(rules):
        if trigram_query(rule.pattern) == ANYTHING:
            possible = text_or_empty().rlike(rule.pattern)
        else:
            possible = F.array_contains(F.coalesce(kinds, F.array().cast("array<string>")), rule.kind)
        found.append(F.when(possible, rule_spans(text_or_empty(), rule, order)).otherwise(empty))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return joined.select(*kept, F.array_sort(F.concat(*found)).alias(spans)), spans


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` (doc_id, text) as (doc_id, text, secrets): see ``with_secrets``."""
    found, spans = with_secrets(plain(docs, "doc_id", "text"), rules)
    return found.select("doc_id", text_or_empty().alias("text"), F.col(spans).alias("secrets"))


def _listed(spans: Column) -> Column:
    text = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(text, ",")


def secret_report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every document."""
    found = find_secrets(docs)
    base = F.filter("secrets", lambda s: s["place"] < len(BASE))
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *(count(r.kind) for r in BASE), F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
                        _listed(F.col("secrets")).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span, overlapping ones joined, replaced by a mark."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, span):
        gap = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark = F.when(span["start"] >= state["at"], F.concat(state["out"], gap, F.lit("[secret]"))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), mark.alias("out"))

    rest = lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, rest)).otherwise(text)


def redact_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` replaced; all columns and rows stay, a text without secrets as it was.

    A column ``n_chars`` is brought up to the new length of a changed text.

    Every text is redacted where its spans are found, so repeated ids keep their own texts and texts are dealt out once.
    """
    found, spans = with_secrets(docs)
    changed = F.size(spans) > 0
    clean, = unused(found, 1)
    found = found.withColumn(clean, F.when(changed, redacted(text_or_empty(), F.col(spans))))
    new = {"text": F.coalesce(clean, "text")}
    if "n_chars" in docs.columns:
        size = F.char_length(clean).cast(dict(docs.dtypes)["n_chars"])
        new["n_chars"] = F.when(changed, size).otherwise(F.col("n_chars"))
    return found.select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def _span_sql(rule: Rule, order: int) -> str:
    pattern = rule.pattern.replace("'", "''").replace(r"\x20", " ")
    return f"""
    select doc_id, {order} as place, '{rule.kind}' as kind,
      (coalesce(list_sum(list_transform(gaps[1:i], lambda x: length(x))), 0)
        + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))::bigint as s, length(hits[i]) as n
    from (select doc_id, gaps, hits, vals, unnest(range(1, len(hits) + 1)) as i
          from (select doc_id, string_split_regex(t, '{pattern}') as gaps, regexp_extract_all(t, '{pattern}') as hits,
                  regexp_extract_all(t, '{pattern}', {rule.group}) as vals
                from (select doc_id, coalesce(text, '') as t from documents))
          where len(hits) > 0)
    where length(vals[i]) >= {rule.least}"""


def report_sql() -> str:
    """The same report for DuckDB, every rule matched against every text."""
    spans = " union all ".join(_span_sql(r, i) for i, r in enumerate(RULES))
    counts = ", ".join(f"count(*) filter (kind = '{r.kind}') as n_{r.kind}" for r in BASE)
    names = ", ".join(f"coalesce(n_{r.kind}, 0)::bigint as n_{r.kind}" for r in BASE)
    item = "kind || ':' || s || ':' || (s + n)"
    return f"""
    with found as ({spans}),
    grouped as (select doc_id, {counts},
        string_agg({item}, ',' order by s, place) filter (place < {len(BASE)}) as base,
        string_agg({item}, ',' order by s, place) as spans
      from found group by doc_id)
    select d.doc_id, {names}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from documents d left join grouped g on d.doc_id = g.doc_id"""
