"""The daily job over any number of runs at once (one run or a backfill).

entries -> normalise (registry gate) -> recency range join to runs ->
multi-run dedup against the ledger -> request packs -> scoring (answers
parsed and matched, or a scorer) -> selection with fallback -> header and
message -> publication -> commit: ledger marks and verdict upsert only for
runs that published.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions import text as T
from feedlake.operators import ingest as I
from feedlake.operators import ledger as LG
from feedlake.operators.metrics import stage_counts
from feedlake.operators import recency as R
from feedlake.operators import report as RP
from feedlake.operators import scoring as S
from feedlake.operators import verdicts as V
from feedlake.sources import journal as J
from feedlake.sources import store as ST
from feedlake.sources.tables import materialize

DEFAULT_TEMPLATE = "Articles : {articles_json}"


def run_daily(spark: SparkSession, entries: DataFrame, sources: DataFrame, runs: DataFrame,
              ledger_path: str, store_path: str, answers: DataFrame | None = None,
              run_status: DataFrame | None = None, hours: int = vocab.RECENCY_HOURS,
              template: str = DEFAULT_TEMPLATE, commit: bool = True,
              collapse_in_batch: bool = False, clip_description: bool = False,
              publish: Callable[[DataFrame], DataFrame | None] | None = None,
              ask: Callable[[DataFrame, int], DataFrame] | None = None,
              journal_path: str | None = None, show_unanswered: bool = True,
              mark_unshown: bool = True) -> dict[str, DataFrame]:
    """Run the daily job for every run in ``runs``.

    ``runs`` must hold fixed times (not ``current_timestamp()``): they are
    compared again at every step. ``answers``: (run_ts, first_pos, doc) answer
    documents; ``ask(requests, attempt)`` fetches them instead, in bounded
    rounds for the requests that have no usable one yet. Without either the
    rule scorer stands in for the model. A run without a usable answer falls
    back; in other runs the items that nothing answered are shown as fallback
    rows, so that no item is marked unseen (``show_unanswered`` off: the
    original leaves out what the answer leaves out). A run on the fallback
    shows its first items and marks all, as the original does;
    ``mark_unshown`` off leaves the others new for the next job.

    ``run_status``: (run_ts, ok), publication outcomes known beforehand (a
    replay); a run it does not list has not published. ``publish`` writes the
    payloads and returns the (run_ts, ok) of this publication, or None when
    all went out. It is called before anything is committed; if it fails, or
    for a run that it reports as failed, nothing is committed and the items
    stay new for the next job. The store is written before the ledger: an item
    is only marked once its verdict is kept. With ``journal_path`` the commit
    is written ahead there, and what a killed job left is completed first.

    Items are visible from ``fetched_at`` on, where entries carry it, else
    from their publication date. ``collapse_in_batch`` keeps one copy of a link
    seen twice in a run (off: the original scores both); ``clip_description``
    clips the message description to 4,096 characters (off: only the size
    guard protects it).
    """
    if journal_path:
        J.recover(spark, journal_path, publish, ledger_path, store_path)
    items = I.normalize(entries, sources) if "hash" not in entries.columns else entries
    arrival = "fetched_at" if "fetched_at" in items.columns else "published_at"
    pairs = R.items_per_run(items, runs, hours, fetched_col=arrival)
    status = run_status if run_status is not None else runs.withColumn("ok", F.lit(True))
    # what is read several times below is written once: the new items (by their numbering), the
    # usable answers, the verdicts, and what has a row for each run, which joins can then broadcast
    status = materialize(status.select("run_ts", "ok"), "job-status")
    new = LG.new_per_run(pairs, ST.read_ledger_log(spark, ledger_path), status)
    if collapse_in_batch:          # Q3: the original keeps both copies
        new = LG.in_batch_collapse(new)
    sent = V.batched(new)
    new = sent.select(*new.columns)
    requests = V.pack_requests(sent, template)

    if ask is not None:
        found, _ = V.ask_in_rounds(requests, ask)
        answers = found.withColumn("first_pos", F.col("batch_no") * V.DEFAULT_BATCH_ITEMS)
    if answers is not None:
        good = materialize(answers.filter(V.is_usable()), "usable-answers")
        parsed = V.validate(V.parse_documents(good, "run_ts", offset_col="first_pos"))
        ok = materialize(good.select("run_ts").distinct().withColumn("usable", F.lit(True)), "usable-runs")
        verdicts = V.match(parsed, new).withColumn("is_fallback", F.lit(False))
        if show_unanswered:
            verdicts = verdicts.unionByName(V.unanswered(sent, parsed, ok), allowMissingColumns=True)
        verdicts = materialize(verdicts, "job-verdicts")
        head_docs = good.filter(F.col("first_pos") == 0)
    else:
        text = S.rule_text(F.col("title"), F.col("summary"))
        verdicts = (S.rubric_score(new, text)
                    .withColumn("response_pos", F.col("entry_pos").cast("bigint"))
                    .withColumn("reason", F.lit("")).withColumn("translated_title", F.lit("")))
        ok = new.select("run_ts").distinct().withColumn("usable", F.lit(True))
        head_docs = ok.select("run_ts", F.lit(None).cast("string").alias("doc"))

    # rows of one position (entries of several files) are told apart by their link
    order = ("response_pos", "link") if answers is None else ("response_pos",)
    chosen = V.with_fallback(new, verdicts, ok, tiebreak=order, ident=order,
                             arrival=("source", "entry_pos", "link"))
    header = V.digest_header(new, verdicts.join(ok.filter("usable"), "run_ts", "left_semi"),
                             head_docs, ok_runs=ok)
    to_mark = new if mark_unshown else V.shown_or_answered(new, chosen, ok)
    top = chosen.filter(F.col("section") == "top")
    other = chosen.filter(F.col("section") == "other")
    fields = RP.digest_fields(header, top, other, clip_description=clip_description)
    payload = RP.digest_payload(fields)

    kept = (chosen.withColumn("recorded_at", F.col("run_ts"))
            .withColumn("reason", F.coalesce(F.col("reason"), F.lit("")))
            .withColumn("translated_title", T.strip_ws(F.coalesce(F.col("translated_title"), F.lit("")))))
    if journal_path and commit:
        entry = J.prepare(spark, journal_path, payload, to_mark, kept, status)
        try:
            J.publish_entry(spark, entry, publish)
        except Exception:
            J.drop(spark, entry)  # publication failed: nothing is committed, the items stay new
            raise
        J.complete(spark, entry, publish, ledger_path, store_path)
    else:
        published = status
        if publish is not None:
            outcome = publish(payload)
            if outcome is not None:
                published = materialize(outcome.select("run_ts", "ok"), "job-outcome")
        if commit:
            ST.upsert_store(spark, kept.join(published.filter("ok").select("run_ts"), "run_ts", "left_semi"), store_path)
            ST.append_ledger(LG.gated_marks(to_mark, published).withColumn("seen_at", F.col("run_ts")), ledger_path)
    counters = stage_counts({"recent": pairs, "new": new,
                             "kept": chosen.select("run_ts"),
                             "top": chosen.filter(F.col("section") == "top").select("run_ts")})
    return {"items": items, "pairs": pairs, "new": new, "requests": requests,
            "verdicts": verdicts, "to_mark": to_mark, "digest_items": chosen, "header": header, "payload": payload,
            "stage_counts": counters, "rejected": I.entry_rejections(entries)}
