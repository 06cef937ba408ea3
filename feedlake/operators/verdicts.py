"""Scoring surface: request packing, answer parsing and validation, matching
answers to items, coverage check, rounds of asking and the reconciliation of
requests with answers, digest header, fallback switch, upsert."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions import coerce as C
from feedlake.functions import text as T
from feedlake.operators import select as sel
from feedlake.operators.ranking import ordinal, top_k
from feedlake.sources.tables import materialize

# Keys of answer documents, ours and the original's.
ITEMS_PATHS = ("$.items", "$.articles_analyses")
HEADER_KEYS = {"headline": ("headline", "tldr"), "summary": ("summary", "synthese_journee")}
FIELD_KEYS = {"hash": ("hash", "hash_unique"), "severity": ("severity", "criticite"),
              "score": ("score",), "kept": ("kept", "garde"), "category": ("category", "categorie"),
              "reason": ("reason", "raison_courte"),
              "translated_title": ("translated_title", "titre_traduit")}

# Placeholder of request templates (fixed value).
ITEMS_PLACEHOLDER = "{articles_json}"
DEFAULT_BATCH_ITEMS = 50
#: Calls for one request before its items go to the fallback.
ATTEMPTS = 3
#: Fallback rows of a batch stand after all answered ones of equal rank.
FALLBACK_POS = 1 << 40


def batched(items: DataFrame, group: str = "run_ts", order=("entry_pos",),
            batch_items: int = DEFAULT_BATCH_ITEMS) -> DataFrame:
    """Items with ``pos`` (arrival number in their run, from 1) and ``batch_no`` of the
    request they go out with; the numbering is skew-safe (``ordinal``)."""
    numbered = ordinal(items, [group], list(order), out="pos")
    return numbered.withColumn("batch_no", F.floor((F.col("pos") - 1) / batch_items))


def pack_requests(items: DataFrame, template: str, group: str = "run_ts",
                  order=("entry_pos",), batch_items: int = DEFAULT_BATCH_ITEMS,
                  fields: dict | None = None, replacements: dict | None = None) -> DataFrame:
    """One request document per (run, batch).

    Items are numbered in arrival order per run (skew-safe ordinal) and cut
    into batches of at most ``batch_items``, so no request grows with the
    data. The JSON array keeps the item order; the template's placeholder is
    replaced by it. Items that ``batched`` has numbered keep their batches.
    """
    fields = fields or {"hash_unique": "hash", "titre": "title", "resume": "summary",
                        "source": "source", "categorie_source": "source_category"}
    numbered = items if "batch_no" in items.columns else batched(items, group, order, batch_items)
    obj = F.struct(*[F.col(src).alias(dst) for dst, src in fields.items()])
    packed = (numbered.groupBy(group, "batch_no")
              .agg(F.array_sort(F.collect_list(F.struct(F.col("pos"), obj.alias("o"))))
                   .alias("__items"), F.count(F.lit(1)).alias("n_items")))
    payload = F.to_json(F.transform("__items", lambda x: x["o"]))
    prompt = F.replace(F.lit(template), F.lit(ITEMS_PLACEHOLDER), payload)
    for placeholder, value in (replacements or {}).items():
        prompt = F.replace(prompt, F.lit(placeholder), value)
    return packed.select(group, "batch_no", "n_items", prompt.alias("prompt"))


def _first_of(v: Column, keys: tuple[str, ...], kind: str = "variant") -> Column:
    """The first key that the object has."""
    return F.coalesce(*[F.try_variant_get(v, k if k.startswith("$") else f"$.{k}", kind)
                        for k in keys])


def parse_documents(docs: DataFrame, key: str, doc_col: str = "doc",
                    items_paths: tuple[str, ...] = ITEMS_PATHS,
                    offset_col: str | None = None) -> DataFrame:
    """Answer documents to one row per answered item.

    Unparseable documents yield no item rows (see ``usable``). The position
    of each item in the run's answer is kept as ``response_pos`` (1-based):
    its place in the document plus the document's ``offset_col``.
    """
    parsed = docs.withColumn("__v", F.try_parse_json(F.col(doc_col)))
    arr = _first_of(F.col("__v"), items_paths, "array<variant>")
    off = F.col(offset_col) if offset_col else F.lit(0)
    return (parsed.select(key, off.alias("__off"), F.posexplode(arr).alias("__p", "__item"))
            .select(key, (F.col("__off") + F.col("__p") + 1).cast("bigint").alias("response_pos"),
                    "__item"))


def validate(answers: DataFrame, field_names: dict | None = None) -> DataFrame:
    """Coerce answered fields with the original rules.

    Each field's value and JSON type are projected once, then coerced.
    """
    f = dict(FIELD_KEYS)
    f.update({n: (k,) for n, k in (field_names or {}).items()})
    it = F.col("__item")
    typed = ["score", "kept", "reason", "translated_title"]
    base = [c for c in answers.columns if c != "__item"]
    step1 = answers.select(*base, *[_first_of(it, f[n]).alias(f"__v_{n}")
                                    for n in f])
    step2 = step1.select("*", *[F.schema_of_variant(F.col(f"__v_{n}")).alias(f"__t_{n}")
                                for n in typed])
    v = lambda n: F.col(f"__v_{n}")
    t = lambda n: F.col(f"__t_{n}")
    out = step2.select(
        *base,
        C.raw_text_of(v("hash"), "").alias("hash"),
        C.allow_severity(C.raw_text_of(v("severity"), vocab.DEFAULT_SEVERITY)).alias("severity"),
        C.allow_category(C.raw_text_of(v("category"), vocab.DEFAULT_CATEGORY)).alias("category"),
        C.score_of(v("score"), t("score")).alias("score"),
        C.truthy(v("kept"), t("kept")).alias("kept"),
        C.text_of(v("reason"), t=t("reason")).alias("reason"),
        C.text_of(v("translated_title"), t=t("translated_title")).alias("translated_title"))
    return out


def is_usable(doc_col: str = "doc") -> Column:
    """Whether a document is a JSON object with a list of items."""
    v = F.try_parse_json(F.col(doc_col))
    return (v.isNotNull() & F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
            & _first_of(v, ITEMS_PATHS, "array<variant>").isNotNull())


def usable(docs: DataFrame, key: str, doc_col: str = "doc") -> DataFrame:
    """Per key: whether every answer document is usable (M4 switch of the whole run)."""
    return docs.groupBy(key).agg(F.bool_and(is_usable(doc_col)).alias("usable"))


def ask_in_rounds(requests: DataFrame, ask: Callable[[DataFrame, int], DataFrame], group: str = "run_ts",
                  attempts: int = ATTEMPTS) -> tuple[DataFrame, DataFrame]:
    """Ask for answers until each request has a usable one, ``attempts`` times at most.

    ``ask(requests, attempt)`` gives (group, batch_no, doc) for the requests it
    is handed; later rounds get those only that are still without a usable
    answer. Returns the usable answers, with ``attempt``, and the requests left.
    """
    pending, found = requests, []
    for attempt in range(1, attempts + 1):
        answers = materialize(ask(pending, attempt).filter(is_usable()).select(
            group, "batch_no", "doc", F.lit(attempt).alias("attempt")).dropDuplicates([group, "batch_no"]), "answers")
        found.append(answers)
        pending = materialize(pending.join(answers, [group, "batch_no"], "left_anti"), "unanswered")
        if pending.isEmpty():
            break
    return reduce(DataFrame.unionByName, found), pending


def reconcile(sent: DataFrame, answered: DataFrame, group: str = "run_ts") -> DataFrame:
    """Hashes sent in each request against those answered in its run (M7, M4).

    ``sent``: (group, batch_no, hash); ``answered``: (group, hash) of usable
    answers. Per request: how many hashes went out, were answered, are missing,
    were answered more than once; and its status: answered, partial or unanswered.
    """
    out = sent.select(group, "batch_no", "hash").distinct()
    back = answered.groupBy(group, "hash").agg(F.count(F.lit(1)).alias("__n"))
    n = F.coalesce("__n", F.lit(0))
    per = out.join(back, [group, "hash"], "left").groupBy(group, "batch_no").agg(
        F.count(F.lit(1)).alias("n_sent"), F.count_if(n > 0).alias("n_answered"),
        F.count_if(n == 0).alias("n_missing"), F.count_if(n > 1).alias("n_repeated"))
    return per.withColumn("status", F.when(F.col("n_missing") == 0, "answered")
                          .when(F.col("n_answered") == 0, "unanswered").otherwise("partial"))


def unanswered(sent: DataFrame, answered: DataFrame, ok_runs: DataFrame, group: str = "run_ts") -> DataFrame:
    """Stand-in verdicts for the items that no usable answer of their run covers, be it that
    their request got none or that its answer left them out: all are shown, as the whole
    run's fallback shows its first ones. Runs without any usable answer are not in it."""
    lost = (sent.join(ok_runs.filter("usable").select(group), group, "left_semi")
            .join(answered.select(group, "hash").distinct(), [group, "hash"], "left_anti"))
    return sel.fallback_verdicts(lost).withColumns(
        {"response_pos": F.col("pos") + FALLBACK_POS, "translated_title": F.lit(""), "is_fallback": F.lit(True)})


def shown_or_answered(new: DataFrame, chosen: DataFrame, ok_runs: DataFrame, group: str = "run_ts") -> DataFrame:
    """Of the new items those that were answered, or shown by a fallback: a run without any usable
    answer shows its first items only, and the others are left out here."""
    whole = run_usable(new, ok_runs, group).filter(~F.col("usable")).select(group)
    seen = chosen.select(group, "hash").distinct()
    return new.join(whole, group, "left_anti").unionByName(
        new.join(whole, group, "left_semi").join(seen, [group, "hash"], "left_semi"))


def latest_items(items: DataFrame, group: str = "run_ts", order: str = "entry_pos") -> DataFrame:
    """The index of the original keeps the last item of a repeated hash; one
    row per (run, hash) via a top-1 (partial limit before the shuffle)."""
    return top_k(items, [group, "hash"], [F.col(order).desc()], 1, out="__r").drop("__r")


def match(answers: DataFrame, items: DataFrame, group: str = "run_ts",
          order: str = "entry_pos") -> DataFrame:
    """Inner join of answers to items on (run, hash) (J2, F3): unknown or
    missing hashes are dropped, repeated answers each give a row."""
    idx = latest_items(items, group, order)
    # answer fields win over same-named item columns
    clash = [c for c in idx.columns if c in answers.columns and c not in (group, "hash")]
    return answers.join(idx.drop(*clash), [group, "hash"], "inner")


def coverage(items: DataFrame, answers: DataFrame, group: str = "run_ts") -> DataFrame:
    """Each input must be answered once with its exact hash (M7): status per
    (run, hash) is ok, missing, unknown or repeated."""
    ni = items.groupBy(group, "hash").agg(F.count(F.lit(1)).alias("n_items"))
    na = answers.groupBy(group, "hash").agg(F.count(F.lit(1)).alias("n_answers"))
    j = ni.join(na, [group, "hash"], "full_outer").fillna(0, ["n_items", "n_answers"])
    status = (F.when(F.col("n_answers") == 0, F.lit("missing"))
              .when(F.col("n_items") == 0, F.lit("unknown"))
              .when(F.col("n_answers") > 1, F.lit("repeated"))
              .otherwise(F.lit("ok")))
    return j.withColumn("status", status)


def run_usable(items: DataFrame, ok_runs: DataFrame, group: str = "run_ts") -> DataFrame:
    """Every run that has items, with ``usable``: a run without any answer
    document is as unusable as one whose answer cannot be read."""
    return (items.select(group).distinct().join(ok_runs.select(group, "usable"), group, "left")
            .withColumn("usable", F.coalesce("usable", F.lit(False))))


def digest_header(items: DataFrame, verdicts: DataFrame, docs: DataFrame,
                  group: str = "run_ts", doc_col: str = "doc",
                  ok_runs: DataFrame | None = None, runs: DataFrame | None = None) -> DataFrame:
    """Per run: items scored, verdicts kept, header texts with defaults.

    With ``ok_runs`` (run, usable), runs on the fallback say so: no headline,
    the fallback summary, and as many kept as the fallback shows. With
    ``runs``, runs without any item get the empty header.
    """
    n_scored = items.groupBy(group).agg(F.count(F.lit(1)).alias("n_scored"))
    n_kept = verdicts.groupBy(group).agg(F.count_if(F.col("kept")).alias("n_kept"))
    v = F.try_parse_json(F.col(doc_col))
    one = docs.groupBy(group).agg(F.min(doc_col).alias(doc_col))  # of several first documents the smallest
    head = one.select(
        group,
        C.text_of(_first_of(v, HEADER_KEYS["headline"])).alias("headline"),
        T.default_text(C.text_of(_first_of(v, HEADER_KEYS["summary"])),
                       vocab.DIGEST_DEFAULT_SUMMARY).alias("summary"))
    out = (n_scored.join(n_kept, group, "left").fillna(0, ["n_kept"])
           .join(head, group, "left").withColumn("is_fallback", F.lit(False)))
    if ok_runs is not None:
        out = out.join(run_usable(items, ok_runs, group), group)
        bad = ~F.col("usable")
        out = out.withColumns({
            "n_kept": F.when(bad, F.least("n_scored", F.lit(vocab.FALLBACK_ITEMS)))
            .otherwise(F.col("n_kept")),
            "headline": F.when(bad, F.lit("")).otherwise(F.col("headline")),
            "summary": F.when(bad, F.lit(vocab.DIGEST_FALLBACK_SUMMARY))
            .otherwise(F.coalesce("summary", F.lit(vocab.DIGEST_DEFAULT_SUMMARY))),
            "is_fallback": bad}).drop("usable")
    if runs is not None:
        empty = runs.select(group).distinct().join(out.select(group), group, "left_anti").select(
            group, F.lit(0).cast("bigint").alias("n_scored"), F.lit(0).cast("bigint").alias("n_kept"),
            F.lit("").alias("headline"), F.lit(vocab.DIGEST_EMPTY_SUMMARY).alias("summary"),
            F.lit(False).alias("is_fallback"))
        out = out.unionByName(empty)
    return out


def digest_items(verdicts: DataFrame, group: str = "run_ts", tiebreak=("response_pos",),
                 ident="response_pos") -> DataFrame:
    """Long form of a digest: section top / other with ranks."""
    top = materialize(sel.daily_top(verdicts, group, tiebreak).withColumn("section", F.lit("top")), "digest-top")
    other = sel.daily_other(verdicts, group, tiebreak, ident=ident) \
        .withColumn("section", F.lit("other"))
    return top.unionByName(other, allowMissingColumns=True)


def with_fallback(items: DataFrame, verdicts: DataFrame, ok_runs: DataFrame,
                  group: str = "run_ts", tiebreak=("response_pos",),
                  ident="response_pos", arrival=("source", "entry_pos")) -> DataFrame:
    """Fallback switch (M4): runs with a usable answer get their selection,
    the others the first items in arrival order, flagged ``is_fallback``."""
    known = materialize(run_usable(items, ok_runs, group), "known-runs")  # a row for each run
    good = known.filter(F.col("usable")).select(group)
    bad = known.filter(~F.col("usable")).select(group)
    chosen = digest_items(verdicts.join(good, group, "left_semi"), group, tiebreak, ident)
    if "is_fallback" not in verdicts.columns:  # else rows of unanswered batches say so
        chosen = chosen.withColumn("is_fallback", F.lit(False))
    fb = materialize(sel.fallback_digest(items.join(bad, group, "left_semi"), group, arrival)
                     .withColumn("section", F.lit("other")).withColumn("is_fallback", F.lit(True)), "digest-fallback")
    return chosen.unionByName(fb, allowMissingColumns=True)


def upsert(store: DataFrame, batch: DataFrame, key: str = "hash",
           order=("recorded_at", "response_pos")) -> DataFrame:
    """Last write wins on ``key`` (K3, INSERT OR REPLACE). One row per key via
    a top-1 per key, which Spark limits per task before the shuffle."""
    both = store.unionByName(batch, allowMissingColumns=True)
    return top_k(both, [key], [F.col(c).desc() for c in order], 1, out="__r").drop("__r")
