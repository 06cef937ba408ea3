"""Report building: the weekly document as ordered lines, chat payloads,
and the file sinks. Everything is set-wise over all weeks / runs.

The weekly document of a week has a line per stored item, so it is kept in
long form ``(week, line_no, line)``: the bounded head (header, top 3,
category table, trends, takeaways) is one small array per week, and body
line numbers come from per-category counts plus the skew-safe rank inside
the category. The text sink writes each week's lines in order. Chat
messages are bounded by their size limits, so only a proven prefix of each
list is ever gathered.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake import vocab
from feedlake.functions import dates as D
from feedlake.functions import labels as L
from feedlake.functions import text as T
from feedlake.operators import weekly as W
from feedlake.session import delete_path, scratch_path
from feedlake.sources.tables import materialize

# fixed values: report and message texts
H_TITLE = "# Récap veille — Semaine "
H_GENERATED = "> Généré automatiquement le "
H_OVERVIEW = "## Vue d'ensemble"
H_RETAINED = "- **Articles retenus** : "
H_PERIOD = "- **Période** : "
H_TOP = "## Top 3 de la semaine"
H_SPLIT = "## Répartition par catégorie"
H_TABLE = "| Catégorie | Nombre |"
H_RULE = "|-----------|--------|"
H_TRENDS = "## Tendances de la semaine"
H_TAKEAWAYS = "## À retenir"
H_ALL = "## Tous les articles de la semaine"
M_DAILY_TITLE = "☀️ Veille du "
M_TOP_NAME = "🎯 À lire en priorité"
M_OTHER_NAME = "📚 Autres articles"
M_SUMMARY_NAME = "💡 Synthèse du jour"
M_RECAP_TITLE = "📅 Récap veille — "
M_RECAP_TOP = "🏆 Top 3 de la semaine"
M_RECAP_SPLIT = "📊 Répartition par catégorie"
M_RECAP_TRENDS = "📈 Tendances de la semaine"
M_RECAP_TAKEAWAYS = "🎯 À retenir"
M_RECAP_ARCHIVE = "📁 Récap complet (Markdown)"
M_ARCHIVE_TEXT = "Voir sur GitHub"

# French display codes of severities, same order as vocab.SEVERITIES
_SEV_FR = dict(zip(vocab.SEVERITIES, vocab.SEVERITIES_FR))


def _s(x) -> Column:
    return x.cast("string") if isinstance(x, Column) else F.lit(str(x))


def _cat(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def week_frame(store: DataFrame, generated_offset: str = "6 days 15 hours") -> DataFrame:
    """Per week: count, bounds and generation time (the job runs Sunday 15:00 UTC)."""
    wk = store.groupBy("week").agg(F.count(F.lit(1)).alias("n"),
                                   F.min("published_at").alias("__any"))
    ws = D.week_start("__any")
    return (wk.withColumn("week_start", ws).withColumn("week_end", D.week_end(ws))
            .withColumn("generated_at", ws + F.expr(f"interval {generated_offset}"))
            .drop("__any"))


def _sorted_lines(df: DataFrame, order: str, lines: Column, out: str) -> DataFrame:
    """Per week, the lines of a bounded list (top 3, six categories, three
    takeaways) as one array in list order."""
    agg = df.groupBy("week").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"),
                                                                      lines.alias("l"))))
                                 .alias("__s"))
    return agg.select("week", F.flatten(F.transform("__s", lambda x: x["l"])).alias(out))


def weekly_report_lines(store: DataFrame, fields: DataFrame, top: DataFrame | None = None
                        ) -> DataFrame:
    """The weekly document, one row per line: (week, line_no, line).

    The head (title, overview, top 3, category table, trends, takeaways) is
    bounded per week and built as one array per week. The body has a line per
    stored item; its line numbers are computed from per-category counts and
    the rank inside the category, so the week is never sorted as a whole.
    """
    f = fields.select("week", "trends", "refs", "takeaways_raw")
    wk = week_frame(store).join(f, "week", "left")
    title = T.display_title(F.col("translated_title"), F.col("title"))
    short = D.date_fr_short

    if top is None:
        top = W.top_referenced(store, f.filter(F.col("refs").isNotNull()))
    top_arr = _sorted_lines(top, "rank", F.array(
        F.lit(""), _cat("### ", _s(F.col("rank")), ". [", title, "](", F.col("link"), ")"),
        F.lit(""),
        _cat("**Criticité** : ", L.report_severity_marker("severity"), " ",
             L.lookup("severity", _SEV_FR, F.col("severity")), "  "),
        _cat("**Catégorie** : ", L.category_marker("category"), " ",
             L.category_label_raw("category"), "  "),
        _cat("**Source** : ", F.col("source"), "  "),
        _cat("**Raison** : ", F.col("reason"))), "__top")
    counts = W.category_counts(store, wk.select("week"))
    split_arr = _sorted_lines(counts, "ord", F.array(
        _cat("| ", L.category_marker("category"), " ", L.category_label("category"), " | ",
             _s(F.col("n")), " |")), "__split")
    tk = W.takeaways(f.filter(F.col("takeaways_raw").isNotNull()))
    tk_arr = _sorted_lines(tk, "rank", F.array(_cat(_s(F.col("rank")), ". ", F.col("text"))),
                           "__tk")

    def lit_arr(*xs):
        return F.array(*[x if isinstance(x, Column) else F.lit(x) for x in xs])

    head_arr = F.concat(
        lit_arr(_cat(H_TITLE, D.week_number("week"), " (du ", short("week_start"), " au ",
                     short("week_end"), ")"),
                "", _cat(H_GENERATED, D.datetime_fr("generated_at"))),
        lit_arr("", H_OVERVIEW, "", _cat(H_RETAINED, _s(F.col("n"))),
                _cat(H_PERIOD, D.date_fr_long("week_start"), " → ", D.date_fr_long("week_end"))),
        lit_arr("", H_TOP),
        F.coalesce(F.col("__top"), lit_arr("", vocab.REPORT_NO_TOP)),
        lit_arr("", H_SPLIT, "", H_TABLE, H_RULE),
        F.col("__split"),
        lit_arr("", H_TRENDS, "", F.coalesce(T.non_empty(F.col("trends")),
                                             F.lit(vocab.REPORT_NO_TRENDS))),
        lit_arr("", H_TAKEAWAYS, ""),
        F.coalesce(F.col("__tk"), lit_arr(vocab.REPORT_NO_TAKEAWAYS)),
        lit_arr("", H_ALL))
    head = (wk.join(top_arr, "week", "left").join(split_arr, "week", "left")
            .join(tk_arr, "week", "left").select("week", head_arr.alias("__head")))
    # one row per week, read twice below: computed once, lineage cut
    head = materialize(head, "report-head")
    head_lines = head.select("week", F.posexplode("__head").alias("__p", "line")).select(
        "week", (F.col("__p") + 1).cast("bigint").alias("line_no"), "line")

    # Body: one section per non-empty category in display order, starting
    # after the head and the sections before it (three header lines each).
    nz = counts.filter(F.col("n") > 0)
    wc = Window.partitionBy("week").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    sections = (nz.withColumn("__before", F.coalesce(F.sum(F.col("n") + 3).over(wc), F.lit(0)))
                .join(head.select("week", F.size("__head").alias("__n_head")), "week", "inner")
                .withColumn("__start", F.col("__n_head") + F.col("__before")))
    cat_hdr = sections.select(
        "week", "__start", F.posexplode(F.array(
            F.lit(""), _cat("### ", L.category_marker("category"), " ",
                            L.category_label("category")), F.lit(""))).alias("k", "line")) \
        .select("week", (F.col("__start") + F.col("k") + 1).cast("bigint").alias("line_no"), "line")
    ranked = W.category_ranked(store)
    starts = sections.select("week", "category", "__start")
    item_rows = ranked.join(starts, ["week", "category"], "inner").select(
        "week", (F.col("__start") + 3 + F.col("rank")).cast("bigint").alias("line_no"),
        _cat("- [", title, "](", F.col("link"), ") — _", F.col("reason"), "_").alias("line"))
    return head_lines.unionByName(cat_hdr).unionByName(item_rows)


def write_weekly_report(lines: DataFrame, path: str) -> None:
    """One file ``<week>.md`` per week, replaced when the week is built again (K5).

    A file has one writer: each week's lines go to one task, sorted there by
    Spark's external sort, and are written to staging; the file is then moved
    under its name, so a reader sees the old report or the new one.
    """
    spark = lines.sparkSession
    staging = scratch_path(spark, "reports")
    (lines.repartition("week").sortWithinPartitions("week", "line_no").select("week", "line")
     .write.partitionBy("week").text(staging))
    jvm = spark.sparkContext._jvm
    p = lambda x: jvm.org.apache.hadoop.fs.Path(x)
    fs = p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p(path))
    for part in fs.globStatus(p(f"{staging}/week=*/part-*")):  # one for each week
        name = part.getPath().getParent().getName().removeprefix("week=")
        target = p(f"{path}/{name}.md")
        if fs.exists(target):
            fs.delete(target, False)
        fs.rename(part.getPath(), target)
    delete_path(spark, staging)


# ------------------------------------------------------------------ daily message
# A list line is at least 8 characters, so no more than this many lines can
# reach the first 1,024 characters of a field; later lines only add length.
_MIN_LINE = 8


def _prefix_cap(limit: int) -> int:
    return limit // _MIN_LINE + 2


def _joined_clip(lines: DataFrame, group: str, sep: str, limit: int, value: str) -> DataFrame:
    """Clip of ``sep.join(lines ordered by rank)`` to ``limit`` characters,
    gathering only the lines that can fall inside the limit plus the total
    length (an aggregate), so the result is exact for any list size."""
    cap = _prefix_cap(limit)
    agg = lines.groupBy(group).agg(
        (F.sum(F.length("line")) + (F.count(F.lit(1)) - 1) * len(sep)).alias("__total"),
        F.array_sort(F.collect_list(F.when(F.col("rank") <= cap, F.struct("rank", "line"))))
        .alias("__head"))
    head = F.array_join(F.transform("__head", lambda x: x["line"]), sep)
    clipped = F.when(F.col("__total") > limit,
                     F.concat(F.substring(head, 1, limit - 1), F.lit("…"))).otherwise(head)
    return agg.select(group, clipped.alias(value), F.least(F.col("__total"), F.lit(limit))
                      .alias(value + "_len"))


def digest_fields(header: DataFrame, top: DataFrame, other: DataFrame,
                  footer: str = vocab.DEFAULT_FOOTER, group: str = "run_ts",
                  clip_description: bool = False) -> DataFrame:
    """Per run: title, description, the three fields with their clipped
    values, total size and the size guard (R7, R8, X1, X2)."""
    title_txt = T.display_title(F.col("translated_title"), F.col("title")) \
        if "translated_title" in top.columns else F.col("title")
    tl = top.select(group, "rank", _cat(L.message_severity_marker("severity"), " [",
                                        T.escape_brackets(title_txt), "](", F.col("link"), ")\n   _",
                                        F.coalesce(F.col("reason"), F.lit("")), "_")
                    .alias("line"))
    ot_title = T.display_title(F.col("translated_title"), F.col("title")) \
        if "translated_title" in other.columns else F.col("title")
    ol = other.select(group, "rank", _cat("• ", L.message_severity_marker("severity"), " [",
                                          T.escape_brackets(ot_title), "](", F.col("link"), ")")
                      .alias("line"))
    tv = _joined_clip(tl, group, "\n\n", vocab.LIMIT_FIELD, "top_value")
    ov = _joined_clip(ol, group, "\n", vocab.LIMIT_FIELD, "other_value")
    h = header.select(
        group,
        T.clip_text(_cat(M_DAILY_TITLE, D.date_fr_long(group)), vocab.LIMIT_TITLE).alias("title"),
        _cat("📊 ", _s(F.col("n_scored")), " articles analysés • ", _s(F.col("n_kept")),
             " retenus").alias("__stats"),
        "headline", "summary")
    desc = F.when(F.length(F.coalesce(F.col("headline"), F.lit(""))) > 0,
                  _cat("**", F.col("headline"), "**\n\n", F.col("__stats"))).otherwise(F.col("__stats"))
    summary_v = T.clip_text(F.col("summary"), vocab.LIMIT_FIELD)
    j = h.join(tv, group, "left").join(ov, group, "left")
    if clip_description:
        desc = T.clip_text(desc, vocab.LIMIT_DESCRIPTION)
    j = j.withColumn("description", desc).withColumn("summary_value", summary_v)
    name_len = {"top": len(M_TOP_NAME), "other": len(M_OTHER_NAME), "summary": len(M_SUMMARY_NAME)}
    top_len = F.when(F.col("top_value").isNotNull(), F.col("top_value_len") + name_len["top"]) \
        .otherwise(0)
    other_len = F.when(F.col("other_value").isNotNull(),
                       F.col("other_value_len") + name_len["other"]).otherwise(0)
    sum_len = F.when(F.length(F.coalesce("summary", F.lit(""))) > 0,
                     F.length("summary_value") + name_len["summary"]).otherwise(0)
    total = F.length("title") + F.length("description") + top_len + other_len + sum_len + len(footer)
    n_fields = (F.col("top_value").isNotNull().cast("int") + F.col("other_value").isNotNull().cast("int")
                + (F.length(F.coalesce("summary", F.lit(""))) > 0).cast("int"))
    return (j.withColumn("total_len", total.cast("int"))
            .withColumn("n_fields", n_fields)
            .withColumn("guarded", F.col("total_len") > vocab.LIMIT_TOTAL)
            .withColumn("n_fields_sent", F.when(F.col("guarded"), F.least(F.col("n_fields"), F.lit(2)))
                        .otherwise(F.col("n_fields")))
            .drop("__stats"))


def digest_payload(fields: DataFrame, footer: str = vocab.DEFAULT_FOOTER,
                   group: str = "run_ts") -> DataFrame:
    """JSON message per run (K7): fields in order, guard applied."""
    fl = F.filter(F.array(
        F.when(F.col("top_value").isNotNull(),
               F.struct(F.lit(M_TOP_NAME).alias("name"), F.col("top_value").alias("value"),
                        F.lit(False).alias("inline"))),
        F.when(F.col("other_value").isNotNull(),
               F.struct(F.lit(M_OTHER_NAME).alias("name"), F.col("other_value").alias("value"),
                        F.lit(False).alias("inline"))),
        F.when(F.length(F.coalesce("summary", F.lit(""))) > 0,
               F.struct(F.lit(M_SUMMARY_NAME).alias("name"), F.col("summary_value").alias("value"),
                        F.lit(False).alias("inline")))), lambda x: x.isNotNull())
    fl = F.when(F.col("guarded"), F.slice(fl, 1, 2)).otherwise(fl)
    embed = F.struct(F.col("title"), F.col("description"), F.lit(vocab.COLOR_BLUE).alias("color"),
                     fl.alias("fields"), F.struct(F.lit(footer).alias("text")).alias("footer"),
                     D.iso_utc(group).alias("timestamp"))
    return fields.select(group, F.to_json(F.struct(F.array(embed).alias("embeds"))).alias("payload"))


def recap_blocks(store: DataFrame, fields: DataFrame, archive_base: str | None = None,
                 archive_dir: str = "docs/reports", top: DataFrame | None = None) -> DataFrame:
    """Texts of the weekly message per week (R9): title and five block
    descriptions, each clipped to 4,096, plus the archive link block.
    Lists inside are bounded (3 highlights, 6 categories, 3 takeaways)."""
    wk = week_frame(store).join(fields, "week", "left")
    if top is None:
        top = W.top_referenced(store, fields)
    title = T.escape_brackets(T.display_title(F.col("translated_title"), F.col("title")))
    tl = top.select("week", "rank", _cat("**", _s(F.col("rank")), ".** ",
                                         L.message_severity_marker("severity"), " [", title, "](",
                                         F.col("link"), ")\n   _", F.col("reason"), "_").alias("line"))
    tv = tl.groupBy("week").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("rank", "line"))), lambda x: x["line"]), "\n\n").alias("top_text"))
    cc = W.category_counts_nonzero(store)
    cv = cc.groupBy("week").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "ord", _cat(L.category_marker("category"), " **", L.category_label("category"), "** — ",
                    _s(F.col("n"))).alias("l")))), lambda x: x["l"]), "\n").alias("split_text"))
    tk = W.takeaways(fields)
    kv = tk.groupBy("week").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "rank", _cat("**", _s(F.col("rank")), ".** ", F.col("text")).alias("l")))),
        lambda x: x["l"]), "\n").alias("tk_text"))
    j = wk.join(tv, "week", "left").join(cv, "week", "left").join(kv, "week", "left")
    clip = lambda c: T.clip_text(c, vocab.LIMIT_DESCRIPTION)
    link = T.archive_link(F.lit(archive_base) if archive_base else F.lit(None).cast("string"),
                          _cat(archive_dir + "/", F.col("week"), ".md"))
    return j.select(
        "week", "generated_at",
        T.clip_text(_cat(M_RECAP_TITLE, F.col("week")), vocab.LIMIT_TITLE).alias("title"),
        clip(_cat("**Du ", D.date_fr_long("week_start"), " au ", D.date_fr_long("week_end"),
                  "**\n\n📊 **", _s(F.col("n")), "** articles retenus cette semaine"))
        .alias("header_text"),
        clip(F.coalesce("top_text", F.lit(vocab.REPORT_NO_TOP))).alias("top_block"),
        clip(F.coalesce("split_text", F.lit(vocab.MESSAGE_NO_SPLIT))).alias("split_block"),
        clip(F.coalesce(T.non_empty(F.col("trends")), F.lit(vocab.REPORT_NO_TRENDS)))
        .alias("trends_block"),
        clip(F.coalesce("tk_text", F.lit(vocab.REPORT_NO_TAKEAWAYS))).alias("takeaways_block"),
        F.when(link.isNotNull(), clip(_cat("[" + M_ARCHIVE_TEXT + "](", link, ")")))
        .alias("archive_block"))


def recap_payload(store: DataFrame, fields: DataFrame, archive_base: str | None = None,
                  archive_dir: str = "docs/reports", top: DataFrame | None = None) -> DataFrame:
    """Weekly message per week (R9): five or six embeds as one JSON text."""
    b = recap_blocks(store, fields, archive_base, archive_dir, top)

    def embed(title, desc, color, with_ts=False):
        parts = [(title if isinstance(title, Column) else F.lit(title)).alias("title"),
                 F.col(desc).alias("description"), F.lit(color).alias("color")]
        if with_ts:
            parts.append(D.iso_utc("generated_at").alias("timestamp"))
        return F.to_json(F.struct(*parts))

    embeds = [embed(F.col("title"), "header_text", vocab.COLOR_BLUE, True),
              embed(M_RECAP_TOP, "top_block", vocab.COLOR_RED),
              embed(M_RECAP_SPLIT, "split_block", vocab.COLOR_GREEN),
              embed(M_RECAP_TRENDS, "trends_block", vocab.COLOR_ORANGE),
              embed(M_RECAP_TAKEAWAYS, "takeaways_block", vocab.COLOR_VIOLET)]
    last = F.when(F.col("archive_block").isNotNull(),
                  embed(M_RECAP_ARCHIVE, "archive_block", vocab.COLOR_GREY))
    arr = F.filter(F.array(*embeds, last), lambda x: x.isNotNull())
    return b.select("week", F.concat(F.lit('{"embeds":['), F.array_join(arr, ","), F.lit("]}"))
                    .alias("payload"))
