"""Secret scans through a trigram inverted index. DataFrame operations only.

From each rule's regular expression a Boolean query of trigrams is derived that every match's text must satisfy:
a string that must occur gives the AND of its trigrams, alternatives give an OR of such ANDs. An index holds, for
each trigram of these queries, a posting for every document it occurs in (lower case, as rules may ignore case).
Postings of a query are intersected per document; documents that satisfy it are candidates, whose whole
texts are verified with the expression itself. A rule without a mandatory trigram is verified on all documents.

Postings are numbers, combined per document and query part before they are shuffled, so a trigram that every
document holds costs one small row per document. Only the texts of candidates are shuffled on.
"""

from __future__ import annotations

import itertools
import re._constants as K
import re._parser as parser
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import whole_text
from martkit.sources.layers import stored


@dataclass(frozen=True)
class Rule:
    """``group`` must have at least ``least`` characters; a match that fails this is dropped, not shortened."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    ignore_case: bool = False

    @property
    def regex(self) -> str:
        return ("(?i)" if self.ignore_case else "") + self.pattern


# Rules that the query's contract fixes (fixed values), in their order.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)
# Rules that the method adds: well-known public token forms (fixed values).
MORE_RULES = (
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 20),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
#: A set of alternatives is followed while it has at most so many strings; beyond, it counts as unknown.
MOST_STRINGS = 32
#: Running sums over a text's matches are taken in blocks of so many.
BLOCK = 128


def trigram_query(rule: Rule) -> tuple[frozenset[str], ...] | None:
    """An OR of ANDs of lower-case trigrams that any match satisfies; None if nothing is mandatory.

    The expression is walked once, left to right. ``open`` holds the strings a run of known characters can be; an
    unknown part ends the run. Each finished run is a condition of its own: the best one, with most trigrams in
    its weakest alternative, is the query.
    """
    found: list[set[str]] = []

    def walk(parsed, open_: set[str]) -> set[str]:
        for op, arg in parsed:
            options: set[str] | None = None
            if op is K.LITERAL:
                options = {chr(arg).lower()}
            elif op is K.IN and all(o is K.LITERAL for o, _ in arg):
                options = {chr(c).lower() for _, c in arg}
            elif op is K.SUBPATTERN:
                open_ = walk(arg[3], open_)
                continue
            elif op is K.BRANCH:
                before, open_ = open_, set()
                for branch in arg[1]:
                    mark = len(found)
                    open_ |= walk(branch, set(before))
                    del found[mark:]  # a run inside one branch is not mandatory
                options = {""}
            elif op in (K.MAX_REPEAT, K.MIN_REPEAT):
                least, most, inner = arg
                if (least, most) == (0, 1):
                    mark = len(found)
                    options = walk(inner, {""}) | {""}
                    del found[mark:]
                elif least:
                    open_ = walk(inner, open_)  # once it must occur
                    options = None if most > 1 else {""}
            if options is None or len(open_) * len(options) > MOST_STRINGS:
                found.append(open_)
                open_ = {""}
            else:
                open_ = {a + b for a, b in itertools.product(open_, options)}
        return open_

    found.append(walk(parser.parse(rule.pattern), {""}))
    queries = [[frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run] for run in found]
    best = max((q for q in queries if q and all(q)), key=lambda q: min(map(len, q)), default=None)
    # An AND that asks for more than another one adds nothing.
    return tuple(sorted({q for q in best if not any(o < q for o in best)}, key=sorted)) if best else None


def postings(docs: DataFrame, trigrams: Sequence[str], key: Sequence[str] = ("doc_id", "text_hash")) -> DataFrame:
    """The inverted index of some trigrams: (trigram, key...) of every document whose lower-case text has it.

    docs needs the key columns and text. Each text is searched for each trigram where it is read, so nothing
    but postings leaves the scan.
    """
    held = F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("_lower"), t))
    return docs.select(*key, F.lower(whole_text()).alias("_lower")).select(*key, F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: Sequence[Rule], key: Sequence[str] = ("doc_id", "text_hash")) -> DataFrame:
    """(key..., kinds): documents that satisfy the trigram query of a rule, with the rules' kinds.

    Rules without a query are not in it: all documents are their candidates.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r))}
    parts = [(kind, i, t) for kind, q in queries.items() for i, ands in enumerate(q) for t in sorted(ands)]
    trigrams = sorted({t for _, _, t in parts})
    index = postings(docs, trigrams, key)
    asked = {t: [(k, i) for k, i, x in parts if x == t] for t in trigrams}
    sizes = {(k, i): len(ands) for k, q in queries.items() for i, ands in enumerate(q)}
    number = {part: n for n, part in enumerate(sizes)}
    # Which query parts a trigram belongs to is a lookup in a constant map, not a join.
    lookup = F.create_map(*[x for t in trigrams for x in (F.lit(t), F.array(*[F.lit(number[p]) for p in asked[t]]))])
    need = F.create_map(*[x for p, n in number.items() for x in (F.lit(n), F.lit(sizes[p]))])
    kind = F.create_map(*[x for (k, _), n in number.items() for x in (F.lit(n), F.lit(k))])
    # A row has each trigram once, so the size of an intersection is a count (rows that repeat can only add
    # candidates, and verification is exact).
    met = (
        index.select(*key, F.explode(lookup[F.col("trigram")]).alias("part"))
        .groupBy(*key, "part")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        met.filter(F.col("n") >= need[F.col("part")])
        .groupBy(*key)
        .agg(F.collect_set(kind[F.col("part")]).alias("kinds"))
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _running(lengths: Column) -> Column:
    """Sums of all elements up to each one, of a non-empty array.

    Arrays can't grow in place, so appending to one costs its length. Sums are therefore appended within blocks of
    ``BLOCK`` elements, and the blocks' totals once per block: a text of 100,000 matches takes a second, not minutes.
    """

    def sums(values: Column) -> Column:
        start = F.array(F.lit(0))
        return F.aggregate(values, start, lambda done, v: F.concat(done, F.array(F.element_at(done, -1) + v)))

    def blocks(values: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        return F.transform(numbers, lambda b: sums(F.slice(values, b * BLOCK + 1, BLOCK)))

    def joined(parts: Column) -> Column:
        before = sums(F.transform(parts, lambda p: F.element_at(p, -1)))
        shifted = F.zip_with(parts, F.slice(before, 1, F.size(parts)), lambda p, at: F.transform(F.slice(p, 2, BLOCK), lambda v: v + at))
        return F.flatten(shifted)

    return _let(lengths, lambda values: _let(blocks(values), joined))


def _spans(text: Column, rule: Rule) -> Column:
    """Array of (start, end, kind) of one rule's matches, in code points.

    What stands between the matches comes from splitting by the expression, so ends are running sums of both.
    """
    pattern = F.lit(rule.regex)
    between = F.transform(F.split(text, rule.regex, -1), F.char_length)
    matched = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.char_length)
    measured = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.char_length)
    pairs = F.arrays_zip(between.alias("gap"), matched.alias("size"), measured.alias("value"))

    def spans(pairs: Column) -> Column:
        # The last gap has no match behind it: its size and value are null.
        ends = _running(F.transform(pairs, lambda p: p["gap"] + F.coalesce(p["size"], F.lit(0))))
        placed = F.zip_with(
            pairs, ends, lambda p, end: F.struct((end - p["size"]).alias("start"), end.alias("end"), p["value"].alias("value"))
        )
        kept = F.filter(placed, lambda s: s["value"] >= rule.least)
        return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))

    return _let(pairs, spans)


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + MORE_RULES) -> DataFrame:
    """One row per row of docs: doc_id and spans, an array of (start, end, kind) by start, then rule order.

    Null text counts as empty, null ids and repeated rows are kept. Matches are leftmost and don't overlap, per rule.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    indexed = [r for r in rules if trigram_query(r)]
    found = stored(candidates(keyed, indexed), "candidates")
    same = keyed["doc_id"].eqNullSafe(found["doc_id"]) & keyed["text_hash"].eqNullSafe(found["text_hash"])
    text = whole_text()
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def verified(rule: Rule) -> Column:
        wanted = F.array_contains("kinds", rule.kind) if rule in indexed else F.lit(True)
        if _one_class(rule):
            # A match that is too short is a whole run of the class, so asking for long runs finds the same rest.
            rule = replace(rule, pattern=f"{rule.pattern[:-1]}{{{rule.least},}}")
        return F.when(wanted & F.rlike(text, F.lit(rule.regex)), _spans(text, rule)).otherwise(none)

    order = {r.kind: i for i, r in enumerate(rules)}
    rank = F.create_map(*[x for k, i in order.items() for x in (F.lit(k), F.lit(i))])
    # Sorted by start, then by the rule's place: places go into the sort key and come out again.
    all_spans = F.transform(
        F.concat(*[verified(r) for r in rules]),
        lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")),
    )
    back = F.transform(F.array_sort(all_spans), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return keyed.join(found, same, "left").select(keyed["doc_id"], back.alias("spans"))


def _one_class(rule: Rule) -> bool:
    """True if the expression is one character class with a plus, and the whole match is measured."""
    parsed = list(parser.parse(rule.pattern))
    return not rule.group and len(parsed) == 1 and parsed[0][0] is K.MAX_REPEAT and rule.pattern.endswith("]+")


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
