"""Secret scans with a trigram inverted index (built-in functions only).

1. Each rule's regular expression is turned into a Boolean trigram query: every
   text it matches contains one of the query's sets of trigrams.
2. The index holds, for the trigrams of these queries, the postings (trigram,
   document) over the lower-cased texts.
3. Postings are intersected by document and the queries evaluated on them.
4. Candidates - and, for rules without a mandatory trigram, every document -
   are verified with the regular expression itself.

Spans are code points, end exclusive.  Defined cases: a null text counts as
empty and has no spans; a null doc_id is kept; repeated rows give repeated
results; within one kind matches do not overlap, spans of different kinds may;
redaction joins overlapping spans.  Texts of any length are searched whole; an
empty table gives no rows; redaction carries all columns in a struct of their
own, so their names cannot clash.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from ledgerlens.llm.native import let, row_key, same


@dataclass(frozen=True)
class Rule:
    """``pattern`` is valid in Python and Java; a match counts when ``group`` has ``least`` code points."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = True


#: The base rules in their listed order, then the rules this method adds.
RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", base=False),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]+", base=False),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", base=False),
)

#: Strings a part of an expression may stand for before it counts as "anything".
_MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Alternative sets of lower-case trigrams, one of which every match
    contains whole; ``[]`` when no trigram is mandatory."""
    clauses: list[list[frozenset[str]]] = []

    def spellings(item) -> set[str] | None:
        """All lower-cased strings the item can match, None if too many."""
        op, arg = item
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN:
            found: set[str] = set()
            for kind, value in arg:
                if kind is sre.LITERAL:
                    found.add(chr(value).lower())
                elif kind is sre.RANGE and value[1] - value[0] < 8:
                    found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
                else:
                    return None
            return found
        if op is sre.SUBPATTERN:
            return sequence(arg[-1])
        if op is sre.BRANCH:
            parts = [sequence(x) for x in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is sre.MAX_REPEAT and arg[1] <= 3:
            one, out = sequence(arg[2]), {""}
            if one is None:
                return None
            total = {""} if arg[0] == 0 else set()
            for n in range(1, int(arg[1]) + 1):
                out = {a + b for a in out for b in one}
                total |= out if n >= arg[0] else set()
            return total if len(total) <= _MOST_STRINGS else None
        return None

    def sequence(items) -> set[str] | None:
        out = {""}
        for item in items:
            found = spellings(item)
            out = None if found is None else {a + b for a in out for b in found}
            if out is None or len(out) > _MOST_STRINGS:
                return None
        return out

    def close(strings: set[str]) -> None:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() not in sets:
            clauses.append([s for s in sets if not any(t < s for t in sets)])

    run = {""}
    for item in parser.parse(pattern):
        found = spellings(item)
        longer = None if found is None else {a + b for a in run for b in found}
        if longer is not None and len(longer) <= _MOST_STRINGS:
            run = longer
            continue
        close(run)
        run = found or {""}
    close(run)
    # every clause holds for every match: the one with the fewest alternatives, then the longest, is kept
    return sorted(min(clauses, key=lambda c: (len(c), -min(map(len, c)))), key=sorted) if clauses else []


def trigram_index(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Postings (trigram, doc_id, key) of the trigrams that the rules ask for."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for t in clause})
    if not wanted:
        return docs.select(F.lit("").alias("trigram"), "doc_id", "key").limit(0)
    present = let(F.lower("text"), lambda low: F.filter(F.array(*map(F.lit, wanted)), lambda t: low.contains(t)))
    return docs.select("doc_id", "key", F.explode(present).alias("trigram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Intersects postings: (doc_id, key, kinds) of the documents whose trigrams satisfy a rule's query."""
    by_document = postings.groupBy("doc_id", "key").agg(F.collect_set("trigram").alias("found"))

    def holds(clause: frozenset[str]) -> Column:
        need = F.array(*map(F.lit, sorted(clause)))
        return F.size(F.array_intersect("found", need)) == len(clause)

    met = []
    for rule in rules:
        if query := trigram_query(rule.pattern):
            any_clause = holds(query[0])
            for clause in query[1:]:
                any_clause = any_clause | holds(clause)
            met.append(F.when(any_clause, F.lit(rule.kind)))
    kinds = F.array_compact(F.array(*met)) if met else F.array().cast("array<string>")
    return by_document.select("doc_id", "key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _spans(text: Column, order: int, rule: Rule) -> Column:
    """array<struct<start, ord, end>> of the rule's matches in one text."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    kind = "array<struct<start:int,ord:int,end:int>>"

    def place(found: Column) -> Column:
        part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else found
        # what lies between the matches gives their places
        gaps = F.split(text, rule.pattern, -1)
        sized = F.zip_with(found, part, lambda w, p: F.struct(F.length(w).alias("len"),
                                                              (F.length(p) >= rule.least).alias("ok")))
        steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), sized, lambda g, m: F.struct(
            F.length(g).alias("gap"), m["len"].alias("len"), m["ok"].alias("ok")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

        def step(acc: Column, s: Column) -> Column:
            begin = acc["at"] + s["gap"]
            span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), (begin + s["len"]).alias("end"))
            return F.struct((begin + s["len"]).alias("at"),
                            F.when(s["ok"], F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        return F.aggregate(steps, start, step, lambda acc: acc["out"])

    return let(whole, lambda found: F.when(F.size(found) > 0, place(found)).otherwise(F.array().cast(kind)))


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
                 text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, text, ``secret_spans`` (start, ord: place in ``rules``, end; sorted) and the columns in ``keep``."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                      (F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None)).alias("kept"))
    keyed = own.withColumn("key", row_key(F.col("text")))
    hits = candidates(trigram_index(keyed, rules), rules).select(
        F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key"), "kinds")
    joined = keyed.join(hits, (F.col("key") == F.col("hit_key")) & same(F.col("doc_id"), F.col("hit_id")), "left")
    none = F.array().cast("array<struct<start:int,ord:int,end:int>>")
    found = []
    for order, rule in enumerate(rules):
        spans = _spans(F.col("text"), order, rule)
        if trigram_query(rule.pattern):
            spans = F.when(F.coalesce(F.array_contains("kinds", rule.kind), F.lit(False)), spans).otherwise(none)
        found.append(spans)
    return joined.select("doc_id", "text", "kept", F.sort_array(F.flatten(F.array(*found))).alias("secret_spans"))


def _written(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["ord"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, one count a base kind, the digest of the base spans and all spans as text."""
    base = sum(r.base for r in rules)
    found = find_secrets(docs, rules)

    def n_of(order: int) -> Column:
        return F.size(F.filter("secret_spans", lambda s: s["ord"] == order)).cast("long")

    counts = [n_of(i).alias(f"n_{r.kind}") for i, r in enumerate(rules) if r.base]
    own = F.filter("secret_spans", lambda s: s["ord"] < base)
    return found.select("doc_id", *counts, F.sha2(_written(own, rules), 256).alias("base_sha256"),
                        _written(F.col("secret_spans"), rules).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` and ``n_chars`` (where there is one) set anew."""
    found = find_secrets(docs, rules, keep=tuple(docs.columns))

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        text = F.when(fresh, F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"]),
                                      F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), text.alias("out"))

    clean = F.aggregate("secret_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    hit = found.withColumn("clean", F.when(F.size("secret_spans") > 0, clean).otherwise(F.col("kept.text")))
    new = {"text": F.col("clean")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("secret_spans") > 0, F.length("clean").cast("long")) \
            .otherwise(F.col("kept.n_chars"))
    return hit.select(*(new.get(c, F.col(f"kept.`{c}`")).alias(c) for c in docs.columns))
