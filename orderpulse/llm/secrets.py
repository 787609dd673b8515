"""Secret scan through a trigram inverted index, with DataFrame functions only.

Each rule is a regular expression with a minimum length.  A Boolean trigram query is derived from the expression: an
``and`` of clauses, each an ``or`` of trigram sets that every match must contain.  The index holds one posting per
trigram of the rules' queries and document key.  Postings are intersected per key, candidates are verified with the
expression itself over the whole text, and rules whose expression has no mandatory trigram are verified on every text.

Edge cases: a missing text counts as empty; a missing key is a key of its own; repeated rows are scanned and returned
one by one (a key's candidates are those of all its rows, a superset that verification corrects); an empty table gives
no rows; columns beyond key and text are neither read nor returned, except by :func:`redact`, whatever their names.
"""

from __future__ import annotations

import functools
import itertools
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_parser, _ops = re._parser, re._constants

#: Alternatives that a literal run may stand for before the run is cut.
MOST_ALTERNATIVES = 64
#: Trigrams per bit mask.
WORD = 62


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token")))

# fixed values: the three base rules
BASE = (
    Rule(
        "assign",
        rf"""({_NAMES}|{_either_case("api")}_?{_either_case("key")})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        12,
        2,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 18),
    Rule("hex", r"[0-9a-f]+", 16),
)
#: Published token shapes that only the index makes cheap to look for in every text.
ADDED = (
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("live_key", r"[rs]k_live_[A-Za-z0-9]+", 24),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 40),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
)
RULES = BASE + ADDED

Clause = frozenset[frozenset[str]]


# --- from an expression to its trigram query -------------------------------------------------------------------------


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold for the lower-cased text around any match; none if nothing is mandatory."""
    clauses: list[Clause] = []
    _walk(_parser.parse(pattern), {""}, clauses, last=True)
    return list(dict.fromkeys(c for c in clauses if c and frozenset() not in c))


def _flush(runs: set[str], clauses: list[Clause]) -> set[str]:
    """End a literal run: one of its alternatives is in the text, so are that alternative's trigrams."""
    sets = {frozenset(r[i : i + 3] for i in range(len(r) - 2)) for r in runs}
    clauses.append(frozenset(s for s in sets if not any(o < s for o in sets)))
    return {""}


def _product(runs: set[str], items: set[str] | None, clauses: list[Clause]) -> set[str]:
    if items is None:
        return _flush(runs, clauses)
    if len(runs) * len(items) > MOST_ALTERNATIVES:
        runs = _flush(runs, clauses)
    return {a + b for a, b in itertools.product(runs, items)} if len(items) <= MOST_ALTERNATIVES else {""}


def _exact(tree) -> set[str] | None:
    """Every string the tree can match, lower-cased, if there are few of them."""
    out = {""}
    for op, arg in tree:
        if op is _ops.LITERAL:
            part = {chr(arg).lower()}
        elif op is _ops.IN and all(o is _ops.LITERAL for o, _ in arg):
            part = {chr(c).lower() for _, c in arg}
        elif op is _ops.SUBPATTERN:
            part = _exact(arg[3])
        elif op is _ops.BRANCH:
            each = [_exact(t) for t in arg[1]]
            part = None if None in each else set().union(*each)
        elif op is _ops.MAX_REPEAT and arg[:2] == (0, 1):
            inner = _exact(arg[2])
            part = None if inner is None else inner | {""}
        elif op is _ops.MAX_REPEAT and arg[0] == arg[1] and arg[0] <= 8:
            inner = _exact(arg[2])
            part = None if inner is None else {"".join(p) for p in itertools.product(inner, repeat=arg[0])}
        else:
            part = None
        if part is None or len(out) * len(part) > MOST_ALTERNATIVES:
            return None
        out = {a + b for a in out for b in part}
    return out


def _walk(tree, runs: set[str], clauses: list[Clause], last: bool = False) -> set[str]:
    for node in tree:
        op, arg = node
        items = _exact([node])
        if items is not None:
            runs = _product(runs, items, clauses)
        elif op is _ops.SUBPATTERN:
            runs = _walk(arg[3], runs, clauses)
        else:
            runs = _flush(runs, clauses)
            if op is _ops.MAX_REPEAT and arg[0] >= 1:
                runs = _flush(_walk(arg[2], {""}, clauses), clauses)
            elif op is _ops.BRANCH:
                # any alternative may have matched: one clause of those alternatives' combined needs
                each = []
                for alternative in arg[1]:
                    inner: list[Clause] = []
                    _walk(alternative, {""}, inner, last=True)
                    usable = [c for c in inner if c and frozenset() not in c]
                    each.append({frozenset().union(*pick) for pick in itertools.product(*usable)} if usable else {frozenset()})
                clauses.append(frozenset().union(*each))
    return _flush(runs, clauses) if last else runs


# --- the index -------------------------------------------------------------------------------------------------------


def vocabulary(rules: Sequence[Rule] = RULES) -> list[str]:
    """The trigrams that the rules' queries ask for."""
    return sorted({g for r in rules for clause in trigram_query(r.pattern) for branch in clause for g in branch})


def trigram_postings(docs: DataFrame, trigrams: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(gram, key)``: the documents that hold each trigram, letters in either case.

    Lower-casing maps ASCII letters to themselves in lower case and keeps neighbours together, so nothing is missed.
    """
    lower = F.lower(F.coalesce(F.col(text), F.lit("")))
    found = docs.select(F.col(key).alias("key"), lower.alias("_t")).select(
        "key", F.filter(F.array(*[F.when(F.contains("_t", F.lit(g)), F.lit(g)) for g in trigrams]), lambda g: g.isNotNull()).alias("_g")
    )
    return found.select(F.explode("_g").alias("gram"), "key")


def candidates(postings: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Intersect postings: one row per key with a flag ``c_<kind>`` for each rule that has mandatory trigrams.

    A key's postings are folded into bit masks inside each task before they are shuffled.
    """
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    grams = vocabulary(rules)
    bit = {g: divmod(i, WORD) for i, g in enumerate(grams)}
    words = range(-(-len(grams) // WORD))

    def word_of(w: int) -> Column:
        own = {g: b for g, (at, b) in bit.items() if at == w}
        return F.coalesce(*[F.when(F.col("gram") == g, F.lit(1 << b)) for g, b in own.items()], F.lit(0)).cast("long")

    masks = postings.where(F.col("gram").isin(grams)).groupBy("key").agg(
        *[F.bit_or(word_of(w)).alias(f"_m{w}") for w in words]
    )

    def holds(branch: frozenset[str]) -> Column:
        need = [sum(1 << bit[g][1] for g in branch if bit[g][0] == w) for w in words]
        return functools.reduce(
            Column.__and__, [F.col(f"_m{w}").bitwiseAND(F.lit(n).cast("long")) == n for w, n in enumerate(need) if n]
        )

    flags = {
        kind: functools.reduce(
            Column.__and__, [functools.reduce(Column.__or__, map(holds, sorted(clause, key=sorted))) for clause in query]
        )
        for kind, query in queries.items()
    }
    return masks.select("key", *[c.alias(f"c_{k}") for k, c in flags.items()]).where(
        functools.reduce(Column.__or__, [F.col(f"c_{k}") for k in flags])
    )


# --- verification ----------------------------------------------------------------------------------------------------


def _spans(text: Column, rule: Rule, number: int) -> Column:
    """Array of ``(start, number, end, kind)`` of a rule's matches, in code points.

    The texts between matches and the matches themselves have the same length function, so running totals give places.
    """
    pattern = F.lit(rule.pattern)
    pieces = F.zip_with(
        F.split(text, rule.pattern, -1),
        F.zip_with(
            F.regexp_extract_all(text, pattern, F.lit(0)),
            F.regexp_extract_all(text, pattern, F.lit(rule.group)),
            lambda m, g: F.struct(F.length(m).alias("m"), F.length(g).alias("g")),
        ),
        lambda gap, m: F.struct(F.length(gap).alias("gap"), m["m"].alias("m"), m["g"].alias("g")),
    )
    kind = "array<struct<start:int,number:int,end:int,kind:string>>"

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + p["gap"]
        span = F.struct(
            start.alias("start"), F.lit(number).alias("number"), (start + p["m"]).alias("end"), F.lit(rule.kind).alias("kind")
        )
        return F.struct(
            (start + F.coalesce(p["m"], F.lit(0))).alias("at"),
            F.when(p["g"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).cast(kind).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))
    return F.aggregate(pieces, start, step, lambda acc: acc["out"])


def find_secrets(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: Sequence[Rule] = RULES
) -> DataFrame:
    """One row per document: ``key`` and ``_spans``, sorted by start, then by rule.

    A span is ``(start, number of the rule, end, kind)``, end exclusive.  Candidates come from the trigram index.
    """
    found = _scanned(docs, F.struct(key, text), key, text, rules)
    return found.select(F.col("row")[key].alias(key), F.col("spans").alias("_spans"))


def _scanned(docs: DataFrame, row: Column, key: str, text: str, rules: Sequence[Rule]) -> DataFrame:
    """Rows ``row, spans``; ``row`` is a struct that holds key and text at least, so no name in it can clash."""
    found = candidates(trigram_postings(docs, vocabulary(rules), key, text), rules)
    # the small side is hashed, so the texts are shuffled but not sorted
    kept = docs.select(row.alias("row"))
    joined = kept.join(found.hint("shuffle_hash"), F.col("row")[key].eqNullSafe(F.col("key")), "left")
    whole = F.coalesce(F.col("row")[text], F.lit(""))
    empty = F.array().cast("array<struct<start:int,number:int,end:int,kind:string>>")
    parts = []
    for number, rule in enumerate(rules):
        if trigram_query(rule.pattern):
            possible = F.coalesce(F.col(f"c_{rule.kind}"), F.lit(False))
        else:
            possible = whole.rlike(rule.pattern if rule.least < 2 or rule.group else _at_least(rule))
        parts.append(F.when(possible, _spans(whole, rule, number)).otherwise(empty))
    return joined.select("row", F.array_sort(F.concat(*parts)).alias("spans"))


def _at_least(rule: Rule) -> str:
    """For one repeated class, the same runs with the wanted length; any other expression as it is."""
    single = re.fullmatch(r"(\[[^\]]*\])\+", rule.pattern)
    return f"{single[1]}{{{rule.least}}}" if single else rule.pattern


def joined_spans(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts and spans per document of a table with doc_id and text."""
    base = [r.kind for r in BASE]
    own = lambda *kinds: F.filter("_spans", lambda s: s["kind"].isin(*kinds))
    return find_secrets(docs).select(
        "doc_id",
        *[F.size(own(k)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(joined_spans(own(*base)), 256).alias("base_sha256"),
        joined_spans(F.col("_spans")).alias("spans"),
    )


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every span, overlapping ones merged, replaced by ``mark``.

    A missing text stays missing; a column ``n_chars`` follows the new text.
    """
    found = _scanned(docs, F.struct("*"), key, text, RULES)
    row, whole = F.col("row"), F.col("row")[text]

    def step(acc: Column, s: Column) -> Column:
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.substring(whole, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
            .otherwise(acc["out"])
            .alias("out"),
        )

    clean = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        step,
        lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.length(whole))),
    )
    # written into a struct first, so that the new text is made once
    fresh = found.select("row", F.when(F.size("spans") > 0, F.struct(clean.alias("text"))).alias("new"))
    altered = F.col("new").isNotNull()
    values = {text: F.when(altered, F.col("new")["text"]).otherwise(whole)}
    if "n_chars" in docs.columns:
        size = F.length(F.col("new")["text"]).cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(altered, size).otherwise(row["n_chars"])
    return fresh.select(*[values.get(c, row[c]).alias(c) for c in docs.columns])


def secret_sql() -> str:
    """The result of :func:`secret_digest` in DuckDB's SQL."""
    found = []
    for number, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        found.append(
            f"""SELECT rid, {number} AS number, '{r.kind}' AS kind, unnest(range(len(m))) AS i, unnest(m) AS m, unnest(g) AS g,
                unnest(gaps[1:len(m)]) AS gap FROM (SELECT rid, regexp_extract_all(t, '{p}') AS m,
                regexp_extract_all(t, '{p}', {r.group}) AS g, regexp_split_to_array(t, '{p}') AS gaps FROM d)"""
        )
    least = "CASE number " + " ".join(f"WHEN {n} THEN {r.least}" for n, r in enumerate(RULES)) + " END"
    told = "kind || ':' || first || ':' || final"
    names = ", ".join(f"'{r.kind}'" for r in BASE)
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
        f AS ({" UNION ALL ".join(found)}),
        s AS (SELECT *, (sum(length(gap) + length(m)) OVER (PARTITION BY rid, number ORDER BY i))::BIGINT AS final,
              (final - length(m))::BIGINT AS first FROM f),
        a AS (SELECT rid, {", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in BASE)},
              string_agg({told}, ',' ORDER BY first, number) FILTER (kind IN ({names})) AS base,
              string_agg({told}, ',' ORDER BY first, number) AS spans FROM s WHERE length(g) >= {least} GROUP BY rid)
        SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0)::BIGINT AS n_{r.kind}" for r in BASE)},
        sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (rid)"""
