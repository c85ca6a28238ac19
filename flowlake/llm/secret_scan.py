"""Secret scans over a trigram inverted index.

Every rule is a regular expression. From its parse tree a Boolean query over trigrams is derived on the driver: text that
matches has to contain certain trigrams. The index maps each trigram that some rule needs to the documents that contain
it (in lower case); its postings are intersected and united as the queries say, and only candidate documents are matched
against the rule itself. A rule without a mandatory trigram (only classes, such as long hexadecimal runs) scans fully.

Matches are found by built-in expressions: the text is split at the pattern, so that piece and match lengths add up to
code point positions. Leftmost non-overlapping matches are taken per rule, then those that fail the rule's length test are
dropped (they still consume their text). A private key is matched with its body, so that masking leaves none of it.

Defined results: null text is empty; an id may be null or repeat (postings of equal ids are united, which can only add
candidates); spans of different rules may overlap and are all reported; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from re import _constants as rc, _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.common import packed, text_of


@dataclass(frozen=True)
class Rule:
    """``group`` (0: the whole match) must have at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules.
BASE = [
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
]
# A key in PEM form: up to its END line, whatever lies between but another key's start; where the END line is missing, the
# lines of base64 (also with breaks written as \n, or runs on one line). Repeats of groups are possessive, so that
# Java's matcher takes them in a loop and long keys cost no stack.
_HEADER = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_TO_END = r"(?:(?!-----(?:BEGIN|END) )[\s\S])*+-----END [A-Z ]*PRIVATE KEY-----"
_BREAK = r"(?:[\x20\x09-\x0D\"'+,>]|\\[nr])*+"
_RUN = _BREAK + r"[A-Za-z0-9+/]{16,}={0,2}"
_SHORT = r"[\x20\x09]*+(?:\r?\n|\r|(?:\\r)?\\n)[\x20\x09>]*+[A-Za-z0-9+/=]+(?![^\r\n\\\"'])"  # alone on its line
_PADDED = r"\x20++[A-Za-z0-9+/]+={1,2}(?![A-Za-z0-9+/=])"
_LINES = r"(?:\s*+(?:Proc-Type|DEK-Info): [^\r\n\\]*+)*+" + f"(?:{_RUN}|{_SHORT}|{_PADDED})*+"
EXTRA = [
    Rule("private_key", _HEADER + f"(?:{_TO_END}|{_LINES})"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("bearer", r"(?i)\bbearer\x20+([A-Za-z0-9+/_.=~-]+)", 1, 20),
]
RULES = BASE + EXTRA

ALL = ("all",)  # matches may be anywhere: no trigram is mandatory
_MANY = 16  # alternatives kept apart while strings are put together


# -- deriving the query: a node is ALL, ("tri", text), ("and", nodes) or ("or", nodes)

def _join(op: str, nodes: list) -> tuple:
    flat = list(dict.fromkeys(n for x in nodes for n in (x[1] if x[0] == op else (x,))))
    if op == "and":
        flat = [n for n in flat if n != ALL]
        return ALL if not flat else flat[0] if len(flat) == 1 else ("and", tuple(flat))
    return ALL if ALL in flat or not flat else flat[0] if len(flat) == 1 else ("or", tuple(flat))


def _of_strings(strings: set[str]) -> tuple:
    """What a text must contain if it contains one of the strings."""
    return _join("or", [_join("and", [("tri", s[i:i + 3]) for i in range(len(s) - 2)]) if len(s) > 2 else ALL for s in strings])


def _sequence(items) -> tuple[set[str] | None, tuple]:
    """(the exact strings, or None if too many or unknown; the query) of a run of parsed items."""
    exact: set[str] | None = {""}
    query, whole = [], True
    for item in items:
        strings, inner = _item(item)
        query.append(inner)
        if strings is not None and exact is not None and len(exact) * len(strings) <= _MANY:
            exact = {a + b for a in exact for b in strings}
        else:
            if exact is not None:
                query.append(_of_strings(exact))
            whole, exact = False, strings if strings is not None and len(strings) <= _MANY else {""}
    query.append(_of_strings(exact))
    return (exact if whole else None), _join("and", query)


def _item(item) -> tuple[set[str] | None, tuple]:
    op, arg = item
    if op is rc.LITERAL:
        return {chr(arg).lower()}, ALL
    if op is rc.IN:
        chars: set[str] = set()
        for kind, value in arg:
            if kind is rc.LITERAL:
                chars.add(chr(value).lower())
            elif kind is rc.RANGE and value[1] - value[0] < _MANY:
                chars.update(chr(c).lower() for c in range(value[0], value[1] + 1))
            else:
                return None, ALL
        return (chars if len(chars) <= _MANY else None), ALL
    if op is rc.SUBPATTERN:
        return _sequence(arg[3])
    if op is rc.BRANCH:
        found = [_sequence(branch) for branch in arg[1]]
        query = _join("or", [q for _, q in found])
        strings = [s for s, _ in found]
        return (set().union(*strings) if all(s is not None for s in strings) else None), query
    if op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
        low, high, inner = arg
        strings, query = _sequence(inner)
        if (low, high) == (0, 1) and strings is not None:
            return strings | {""}, ALL
        if low == 0:
            return None, ALL
        # At least once: its strings are there, but not necessarily next to what stands around.
        return None, _join("and", [query, _of_strings(strings) if strings is not None else ALL])
    if op is rc.AT:
        return {""}, ALL
    return None, ALL


def trigram_query(pattern: str) -> tuple:
    return _sequence(rp.parse(pattern))[1]


def trigrams(node: tuple) -> list[str]:
    if node == ALL:
        return []
    return [node[1]] if node[0] == "tri" else list(dict.fromkeys(t for n in node[1] for t in trigrams(n)))


# -- the index

def postings(docs: DataFrame, needed: list[str]) -> DataFrame:
    """The inverted index: (trigram number, doc_id), over the trigrams that some rule needs."""
    text = F.lower(text_of(F.col("text")))
    hits = F.filter(F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(i)) for i, t in enumerate(needed)]), lambda x: x.isNotNull())
    return docs.select("doc_id", F.explode(hits).alias("trigram"))


def _holds(node: tuple, place: dict[str, int], found: Column) -> Column:
    if node[0] == "tri":
        return F.array_contains(found, place[node[1]])
    return reduce(lambda a, b: (a & b) if node[0] == "and" else (a | b), [_holds(n, place, found) for n in node[1]])


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, candidate_of): the indexed rules whose query a document's postings satisfy; no row where there is none."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) != ALL}
    needed = list(dict.fromkeys(t for q in queries.values() for t in trigrams(q)))
    if not needed:
        return docs.select("doc_id", F.array().cast("array<string>").alias("candidate_of")).limit(0)
    place = {t: i for i, t in enumerate(needed)}
    met = postings(docs, needed).groupBy("doc_id").agg(F.collect_set("trigram").alias("found"))
    chosen = F.filter(F.array(*[F.when(_holds(q, place, F.col("found")), F.lit(k)) for k, q in queries.items()]), lambda x: x.isNotNull())
    return met.select("doc_id", chosen.alias("candidate_of")).filter(F.size("candidate_of") > 0)


# -- matching

def _matches(text: Column, rule: Rule) -> Column:
    """Array of (kind, start, end, value) of one rule."""
    whole = F.regexp_extract_all(text, F.lit(f"({rule.pattern})"), F.lit(1)) if not rule.group else None
    if rule.group:
        flags = re.match(r"\(\?[a-z]+\)", rule.pattern)
        head = flags.group(0) if flags else ""
        numbered = f"{head}({rule.pattern[len(head):]})"
        whole = F.regexp_extract_all(text, F.lit(numbered), F.lit(1))
        tested = F.regexp_extract_all(text, F.lit(numbered), F.lit(rule.group + 1))
    else:
        tested = whole
    pieces = F.split(text, rule.pattern, -1)
    zipped = F.arrays_zip(pieces.alias("piece"), whole.alias("match"), tested.alias("tested"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<kind:string,start:int,end:int>>").alias("out"))

    def step(acc, x):
        start = acc["at"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        keep = x["match"].isNotNull() & (F.length(x["tested"]) >= rule.least)
        one = F.array(F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(keep, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(zipped, state, step, lambda acc: acc["out"])


def _could(text: Column, rule: Rule) -> Column:
    """A cheaper test before positions are taken: the tested group's length as a quantifier cannot miss a match."""
    if rule.group == 0 and rule.least and rule.pattern.endswith("]+"):
        tail = rule.pattern[rule.pattern.rindex("["):-1]
        fixed = rule.pattern[: rule.pattern.rindex("[")]
        if re.fullmatch(r"[A-Za-z0-9_-]*", fixed):
            return text.rlike(f"{fixed}{tail}{{{rule.least - len(fixed)}}}")
    return text.rlike(rule.pattern)


def add_spans(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` (doc_id, text, any others) plus ``spans``: array of (kind, start, end), by start, then rule order.

    Positions are code points, the end exclusive.
    """
    rules = RULES if rules is None else rules
    found = candidates(docs.select("doc_id", "text"), rules).withColumnRenamed("doc_id", "_cand")
    joined = docs.join(found, docs["doc_id"].eqNullSafe(found["_cand"]), "left").drop("_cand")
    text, none = text_of(F.col("text")), F.array().cast("array<struct<kind:string,start:int,end:int>>")
    spans = []
    for rule in rules:
        scan = trigram_query(rule.pattern) == ALL
        maybe = _could(text, rule) if scan else F.coalesce(F.array_contains("candidate_of", rule.kind), F.lit(False)) & _could(text, rule)
        spans.append(F.when(maybe, _matches(text, rule)).otherwise(none))
    order = {r.kind: i for i, r in enumerate(rules)}
    ranked = F.transform(F.flatten(F.array(*spans)), lambda s: F.struct(s["start"], _rank(s["kind"], order).alias("rank"), s["end"], s["kind"]))
    return joined.withColumn("spans", F.transform(F.array_sort(ranked), lambda s: F.struct(s["kind"], s["start"], s["end"]))).drop("candidate_of")


def _rank(kind: Column, order: dict[str, int]) -> Column:
    out = F.lit(len(order))
    for k, i in order.items():
        out = F.when(kind == k, F.lit(i)).otherwise(out)
    return out


def spans_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    names = [r.kind for r in BASE]
    found = add_spans(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = spans_text(F.filter("spans", lambda s: s["kind"].isin(names)))
    return found.select("doc_id", *[count(k) for k in names], F.sha2(base, 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span replaced by ``mark`` (overlapping spans by one); all rows and columns stay.

    ``n_chars``, where there is such a column, is counted again for changed texts.
    """
    slim = packed(docs).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"))
    found = add_spans(slim)
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        piece = F.substring(F.col("text"), acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        fresh = s["start"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], F.array(piece, F.lit(mark)))).otherwise(acc["out"]).alias("out"))

    cut = F.aggregate("spans", state, step, lambda acc: F.concat(
        F.array_join(acc["out"], ""), F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    found = found.withColumn("text", F.when(F.size("spans") > 0, cut).otherwise(F.col("text")))
    names = {c: F.col("row").getField(c) for c in docs.columns}
    names["text"] = F.col("text").cast(docs.schema["text"].dataType)
    if "n_chars" in docs.columns:
        names["n_chars"] = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(names["n_chars"])
    return found.select(*[v.alias(c) for c, v in names.items()])
