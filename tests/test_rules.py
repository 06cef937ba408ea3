"""Rule tables of regular expressions: looked up by required strings, decided by ``rlike``."""

import random
import re

from pyspark.sql import functions as F

from feedlake.functions.text import clean_html
from feedlake.operators import scoring as S
from feedlake.plans.q_feeds import FIXTURE_RULES
from feedlake.sources import fixtures as fx


def test_required_strings():
    assert S.required_strings("(?i)(^|[^a-z])(CVE|zero-day)([^a-z]|$)") == ["cve", "zero-day"]
    assert S.required_strings("tutori(al|el)s?") == ["tutori"] and S.required_strings("(abc)+d*") == ["abc"]
    assert S.required_strings("a?b*|xyz") == [] and S.required_strings(r"\p{L}+x") == [] and S.required_strings(".*") == []
    assert S.required_strings("x{0,3}yz(?:cloud|cluster)") in (["cl"], ["cloud", "cluster"], ["yzcl"])
    rng = random.Random(3)
    for _ in range(300):  # whatever matches holds one of them
        parts = [rng.choice(["ab", "(ab|cde)", "x?", "[mn]", "(q|rs)+", "b*", ".", "^", "(kl)?", "(?:uv|)"]) for _ in range(rng.randrange(1, 5))]
        pattern = "(?i)" + "".join(parts)
        needs = S.required_strings(pattern)
        for _ in range(20):
            text = "".join(rng.choice(["ab", "CDE", "x", "m", "q", "RS", "b", "kl", "uv", " "]) for _ in range(6))
            if needs and re.search(pattern, text):
                assert any(s in text.lower() for s in needs), (pattern, text, needs)


def _scored(df):
    return sorted(map(tuple, df.select("entry_id", "rule_id", "severity", "category", "score", "kept").collect()), key=str)


def test_ten_thousand_rules_equal_case(spark, base):
    rng = random.Random(4)
    syllables = ["the", "un", "der", "sch", "la", "ing", "on", "ti", "re", "qu", "zz", "xk", "vw", "ost", "ph", "mb"]
    rules = [(100 + i, S.word("|".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(rng.randrange(1, 3))),
                              right=rng.random() < .5), rng.choice(["critical", "notable", "ignore"]), "backend", rng.randrange(1, 10))
             for i in range(10_000)]
    odd = [(1, "z{0,1}", "notable", "general", 1), (2, r"\p{Lu}\p{L}*q", "important", "ai", 9), (3, "a", "notable", "ai", 2)]
    schema = S.RULE_SCHEMA
    e = fx.entries(spark, base).limit(40)
    text = S.rule_text(F.col("title"), clean_html(F.col("summary")))
    out = S.rubric_join(e, text, spark.createDataFrame(rules + odd, schema))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    texts = {r.entry_id: r.t for r in e.select("entry_id", text.alias("t")).collect()}
    ordered = sorted(rules + odd[2:], key=lambda r: (-r[4], r[0]))
    upper = re.compile(r"[A-ZÀ-Þ][A-Za-zÀ-ɏ]*q")
    first = lambda t: (2,) if upper.search(t) else next(((r[0],) for r in ordered if re.search(r[1], t)), (1,))
    for r in out.collect():
        assert (r.rule_id,) == first(texts[r.entry_id])


def test_rule_table_equals_case_on_all_entries(spark, base):
    e = fx.entries(spark, base)
    text = S.rule_text(F.col("title"), clean_html(F.col("summary")))
    assert _scored(S.rubric_join(e, text, spark.createDataFrame(FIXTURE_RULES, S.RULE_SCHEMA))) == _scored(
        S.rubric_score(e, text, FIXTURE_RULES))
    none = S.rubric_join(e, text, spark.createDataFrame([], S.RULE_SCHEMA))
    assert {(r.rule_id, r.kept) for r in none.collect()} == {(None, False)}
