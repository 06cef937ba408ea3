"""Scoring in place of the model call.

* ``rubric_score`` (M6): the written selection criteria become a rule table
  (pattern, severity, category, weight) matched on title and summary. A
  bounded rule list compiles to one CASE expression (first rule in weight
  order wins): a narrow, code-generated projection with no join or shuffle.
  A rule table given as a DataFrame, of any size, is joined on the first
  characters of the strings that its expressions require; ``rlike`` decides.
* ``score_items`` (M5): a user-supplied pandas scorer run with
  ``mapInPandas`` on Arrow batches; per-row Python stays inside it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from re import _parser as re_parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from feedlake import vocab
from feedlake.functions.coerce import clamp_score
from feedlake.sources.tables import materialize

# Word boundaries are spelled out: Java's \b counts Unicode letters as word
# characters while RE2's and Python's ASCII mode do not; this class means the
# same thing in every engine.
_NW = "[^A-Za-z0-9_]"


def word(alternatives: str, left: bool = True, right: bool = True) -> str:
    """Case-insensitive pattern for whole words (or word starts)."""
    return ("(?i)" + (f"(^|{_NW})" if left else "") + f"({alternatives})"
            + (f"({_NW}|$)" if right else ""))


# fixed values: rule table derived from the written scoring criteria
# (rule_id, pattern, severity, category, weight)
RULES = [
    (1, word("cve|zero-day|0-day|exploit", right=False), "critical", "security", 10),
    (2, "(?i)(supply.chain|packagist|github actions|" + f"(^|{_NW})npm({_NW}|$))",
     "critical", "security", 9),
    (3, word("php|symfony|mysql|postgresql|docker|apache|nginx"), "important", "backend", 8),
    (4, word("owasp|rgaa|wcag"), "important", "security", 8),
    (5, word("openai|anthropic|google") + ".*" + word("api|sdk")[4:], "important", "ai", 7),
    (6, word("tutorial|tutoriel|guide"), "notable", "general", 6),
    (7, word("css|bootstrap|javascript|accessibilit", right=False), "notable", "frontend", 6),
    (8, "(?i)(ci/cd|kubernetes|devops)", "notable", "devops", 6),
    (9, word("react|vue|angular|svelte|nuxt"), "ignore", "frontend", 2),
    (10, word("crypto|nft|web3|blockchain"), "ignore", "general", 1),
]
RULE_SCHEMA = "rule_id int, pattern string, severity string, category string, weight int"


def _ordered(rules):
    return sorted(rules, key=lambda r: (-r[4], r[0]))


def rule_text(title: Column, summary: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit("")))


def rubric_score(items: DataFrame, text: Column, rules=RULES) -> DataFrame:
    """Best matching rule per item as a CASE expression; no match gives
    ``ignore`` / ``general`` / score 1 / not kept."""
    rid: Column | None = None
    for r in _ordered(rules):
        cond = text.rlike(r[1])
        rid = F.when(cond, F.lit(r[0])) if rid is None else rid.when(cond, F.lit(r[0]))
    attrs = F.create_map(*[x for r in rules for x in (
        F.lit(r[0]), F.struct(F.lit(r[2]).alias("severity"), F.lit(r[3]).alias("category"),
                              F.lit(r[4]).alias("weight")))])
    # one regex pass per row (rule_id), then one map lookup for its attributes
    out = items.withColumn("rule_id", rid.cast("int")) \
        .withColumn("__r", F.element_at(attrs, F.col("rule_id")))
    return (out.withColumn("severity", F.coalesce(F.col("__r.severity"),
                                                  F.lit(vocab.DEFAULT_SEVERITY)))
            .withColumn("category", F.coalesce(F.col("__r.category"),
                                               F.lit(vocab.DEFAULT_CATEGORY)))
            .withColumn("score", clamp_score(F.col("__r.weight")).cast("int"))
            .withColumn("kept", F.col("severity") != F.lit(vocab.DEFAULT_SEVERITY))
            .drop("__r"))


def _runs(tree) -> list[list[str]]:
    """Clauses of a parsed regular expression: of each, at least one string is in every match.

    A run of literal characters is a clause of one string, alternatives are one
    of their best clauses together. What may be absent gives none.
    """
    clauses: list[list[str]] = []
    run = ""
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL" and arg < 128:
            run += chr(arg)
            continue
        if name == "AT":  # an anchor takes no character, so the run goes on
            continue
        clauses += [[run]] if run else []
        run = ""
        if name == "SUBPATTERN":
            clauses += _runs(arg[3])
        elif name == "BRANCH":
            best = [_best(_runs(branch)) for branch in arg[1]]
            clauses += [sorted({s for clause in best for s in clause})] if all(best) else []
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] > 0:
            clauses += _runs(arg[2])
        elif name == "ATOMIC_GROUP":
            clauses += _runs(arg)
    return clauses + ([[run]] if run else [])


def _best(clauses: list[list[str]]) -> list[str]:
    """The clause whose shortest string is longest (up to a gram), then the one of fewest strings."""
    return max(clauses, key=lambda c: (min(min(map(len, c)), GRAM), -len(c)), default=[])


def required_strings(pattern: str) -> list[str]:
    """Lower-case ASCII strings of which every match of ``pattern`` has one; none if it can't be told."""
    try:
        return [s.lower() for s in _best(_runs(re_parser.parse(pattern)))]
    except (re.error, OverflowError, RecursionError):  # a form that only the other dialect has
        return []


#: Characters of a text that rules are looked up by.
GRAM = 3


def rubric_join(items: DataFrame, text: Column, rules: DataFrame, key: str = "entry_id") -> DataFrame:
    """Best rule per item (weight, then rule id) from a table of regular expressions of any size.

    ``rules``: rule_id, pattern, severity, category, weight; ``key`` is unique
    in ``items``. A pattern can only match where one of the strings that it
    requires stands, so items meet rules on equal grams, the first characters
    of those strings, and ``rlike`` decides for the pairs that this leaves. Rules
    that require no string are tried on every item, as ``rubric_score`` does.
    """
    t = items.select(key, text.alias("__text"))
    needs = F.udf(required_strings, "array<string>")
    r = materialize(rules.select("rule_id", "pattern", "weight", needs("pattern").alias("strings")), "rules")
    grams = r.select("rule_id", "pattern", "weight", F.explode("strings").alias("string")).select(
        "rule_id", "pattern", "weight", F.left("string", F.lit(GRAM)).alias("gram")).distinct()
    lengths = sorted(x[0] for x in grams.select(F.length("gram")).distinct().collect())  # at most GRAM
    lower = F.lower("__text")
    found = [F.regexp_extract_all(lower, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]
    met = (t.select(key, F.explode(F.array_distinct(F.concat(*found) if found else F.array().cast("array<string>"))).alias("gram"))
           .join(grams, "gram").select(key, "rule_id", "pattern", "weight").distinct())
    hits = met.join(t, key).filter(F.expr("__text rlike pattern")).select(key, "rule_id", "weight")
    for rule in r.filter(F.size("strings") == 0).select("rule_id", "pattern", "weight").collect():
        hits = hits.unionByName(t.filter(F.col("__text").rlike(rule.pattern)).select(
            key, F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.weight).alias("weight")))
    best = hits.groupBy(key).agg(F.min_by("rule_id", F.struct(-F.col("weight"), F.col("rule_id"))).alias("rule_id"))
    told = best.join(rules.select("rule_id", "severity", "category", F.col("weight").alias("score")), "rule_id")
    out = items.join(told, key, "left")
    return (out.withColumn("severity", F.coalesce("severity", F.lit(vocab.DEFAULT_SEVERITY)))
            .withColumn("category", F.coalesce("category", F.lit(vocab.DEFAULT_CATEGORY)))
            .withColumn("score", clamp_score(F.col("score")).cast("int"))
            .withColumn("kept", F.col("severity") != F.lit(vocab.DEFAULT_SEVERITY)))


def keyword_join(items: DataFrame, text: Column, rules: DataFrame, key: str = "entry_id"
                 ) -> DataFrame:
    """Rule table of whole words, for tables of any size: an equi-join on words.

    ``rules``: rule_id, words (lower-case ASCII words), severity, category,
    weight. Each item's distinct words meet the rules' words on equality, so no
    row is compared with every rule; the best rule per item (weight, then rule
    id) is an aggregate that is combined before its shuffle. Same result as
    ``rubric_score`` with ``word(...)`` patterns; unmatched items are kept.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tokens = F.array_distinct(F.split(F.translate(text, upper, lower), _NW + "+"))
    by_word = rules.select(F.explode(F.array_distinct("words")).alias("__word"),
                           F.struct(F.col("weight"), (-F.col("rule_id")).alias("neg"), "rule_id", "severity",
                                    "category").alias("__rule"))
    best = (items.select(key, F.explode(tokens).alias("__word")).join(by_word, "__word")
            .groupBy(key).agg(F.max("__rule").alias("__best")))
    out = items.join(best, key, "left")
    return (out.withColumns({
        "rule_id": F.col("__best.rule_id"),
        "severity": F.coalesce("__best.severity", F.lit(vocab.DEFAULT_SEVERITY)),
        "category": F.coalesce("__best.category", F.lit(vocab.DEFAULT_CATEGORY)),
        "score": clamp_score(F.col("__best.weight")).cast("int")})
        .withColumn("kept", F.col("severity") != F.lit(vocab.DEFAULT_SEVERITY)).drop("__best"))


SCORE_SCHEMA = Ty.StructType([
    Ty.StructField("run_ts", Ty.TimestampNTZType()),
    Ty.StructField("hash", Ty.StringType()),
    Ty.StructField("severity", Ty.StringType()),
    Ty.StructField("score", Ty.IntegerType()),
    Ty.StructField("kept", Ty.BooleanType()),
    Ty.StructField("category", Ty.StringType()),
])


def keyword_scorer(rules=RULES) -> Callable[[Iterator], Iterator]:
    """A pandas scorer (vectorised ``str.contains`` per rule on each Arrow batch)."""
    ordered = _ordered(rules)

    def score(batches):
        import re
        import warnings

        import pandas as pd
        warnings.filterwarnings("ignore", message="This pattern is interpreted")
        for pdf in batches:
            text = (pdf["title"].fillna("") + " " + pdf["summary"].fillna("")).astype(str)
            sev = pd.Series(vocab.DEFAULT_SEVERITY, index=pdf.index)
            cat = pd.Series(vocab.DEFAULT_CATEGORY, index=pdf.index)
            sc = pd.Series(1, index=pdf.index)
            done = pd.Series(False, index=pdf.index)
            for _, pat, s, c, w in ordered:
                # ASCII word classes, as in Java regex without UNICODE_CHARACTER_CLASS
                hit = text.str.contains(pat.replace("(?i)", ""), regex=True,
                                        flags=re.IGNORECASE | re.ASCII) & ~done
                sev[hit], cat[hit], sc[hit] = s, c, w
                done |= hit
            yield pd.DataFrame({"run_ts": pdf["run_ts"], "hash": pdf["hash"], "severity": sev,
                                "score": sc.clip(1, 10).astype("int32"),
                                "kept": sev != vocab.DEFAULT_SEVERITY, "category": cat})
    return score


def score_items(items: DataFrame, scorer: Callable | None = None,
                schema: Ty.StructType = SCORE_SCHEMA) -> DataFrame:
    """Pluggable scorer (M5): ``scorer`` maps an iterator of pandas batches
    (run_ts, hash, title, summary, ...) to verdict batches."""
    scorer = scorer or keyword_scorer()
    cols = [c for c in ["run_ts", "hash", "title", "summary", "source", "source_category"]
            if c in items.columns]
    return items.select(*cols).mapInPandas(scorer, schema)
