"""Queries over the result table: statistics, lists, keywords, search, merge, maintenance."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from palaver import schemas, session
from palaver.functions.scalars import days, fixed, hours, moment
from palaver.operators import collecting, fulltext, keywords, listings, merge, records, rollups, search
from palaver.plans import bindings, stages
from palaver.plans.registry import query
from palaver.sources import files, keyed, statistics


@query
def stored_results(spark, folder):
    """The result table as it is stored, texts left out."""
    return bindings.results(spark, folder).select("comment_id", "ingestion_day", "toxicity_score", "label", "sentiment", "ingestion_time")


@query
def recent_export(spark, folder):
    """The filtered list of recent comments, to CSV and back."""
    chosen = (["negative", "neutral"], True)
    rows = listings.recent_filtered(_newest(spark, folder, 50, *chosen), 50, *chosen)
    path = session.run_folder(spark, "export")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query
def global_statistics(spark, folder):
    return rollups.global_statistics(bindings.results(spark, folder))


@query
def kpi_percentages(spark, folder):
    return rollups.kpi_percentages(rollups.global_statistics(bindings.results(spark, folder)))


@query
def daily_summary(spark, folder):
    return rollups.daily_summary(bindings.results(spark, folder))


@query
def daily_summary_ingested(spark, folder):
    return rollups.daily_summary_ingested(bindings.results(spark, folder))


@query
def daily_summary_recent(spark, folder):
    return rollups.daily_summary_recent(bindings.results(spark, folder, days(7)), bindings.as_of(), 7)


@query
def hourly_activity(spark, folder):
    return rollups.hourly_activity(bindings.results(spark, folder, hours(24)), bindings.as_of())


@query
def timeline_days(spark, folder):
    return rollups.timeline(bindings.results(spark, folder, days(7)), bindings.as_of(), days(7))


@query
def timeline_hours(spark, folder):
    return rollups.timeline(bindings.results(spark, folder, hours(48)), bindings.as_of(), hours(48))


@query
def top_users(spark, folder):
    return rollups.top_users(bindings.results(spark, folder))


@query
def top_users_short(spark, folder):
    return rollups.top_users_short(bindings.results(spark, folder))


@query
def toxicity_histogram(spark, folder):
    return rollups.toxicity_histogram(bindings.results(spark, folder))


@query
def sentiment_distribution(spark, folder):
    return rollups.sentiment_distribution(bindings.results(spark, folder))


@query
def realtime_stats(spark, folder):
    return rollups.realtime_statistics(bindings.results(spark, folder, hours(1)), bindings.as_of(), 60)


@query
def period_stats_hourly(spark, folder):
    return rollups.period_statistics(bindings.results(spark, folder), "hourly")


@query
def period_stats_daily(spark, folder):
    return rollups.period_statistics(bindings.results(spark, folder), "daily")


@query
def period_stats_weekly(spark, folder):
    return rollups.period_statistics(bindings.results(spark, folder), "weekly")


@query
def latest_statistics(spark, folder):
    return rollups.latest_row(rollups.period_statistics(bindings.results(spark, folder), "daily"))


# --- keywords and search ---------------------------------------------------------------------


def _keyworded(spark, folder):
    return keywords.comment_keywords(bindings.results(spark, folder))


def rounded_trending(trending):
    return trending.select("keyword", "count", fixed("sentiment_avg", 6).alias("sentiment_avg"),
                           fixed("toxicity_avg", 6).alias("toxicity_avg"), "last_updated", "first_seen")


@query
def comment_keywords(spark, folder):
    cleaned = stages.clean_stage(bindings.texts(spark, folder))
    found = keywords.comment_keywords(cleaned, "cleaned_message")
    return found.select("comment_id", F.array_join("keywords", " ").alias("keywords"))


@query
def trending_keywords(spark, folder):
    return rounded_trending(keywords.trending(_keyworded(spark, folder)))


@query
def trending_keywords_incremental(spark, folder):
    """Keywords up to a moment as the stored table, later ones merged into it."""
    found = _keyworded(spark, folder)
    cut = F.col("ingestion_time") < bindings.as_of()
    stored, later = keywords.trending(found.filter(cut)), keywords.trending(found.filter(~cut))
    return rounded_trending(keywords.merge_trending(stored, later))


@query
def top_keywords(spark, folder):
    return keywords.top_keywords(keywords.trending(_keyworded(spark, folder)), 20)


WANTED, UNWANTED = ("kill", "die", "thon"), ("pour",)


@query
def keyword_search(spark, folder):
    found = search.search(bindings.texts(spark, folder), "message", any_of=WANTED, none_of=UNWANTED)
    return found.select("comment_id", "post_id", "message")


@query
def posting_table(spark, folder):
    return search.posting_table(bindings.texts(spark, folder), "message")


@query
def keyword_search_postings(spark, folder):
    """The same search answered by the stored postings alone."""
    def write(path):
        search.write_postings(search.posting_table(bindings.texts(spark, folder), "message"), path)
    path = bindings.stored(spark, folder, "postings", write)
    postings = search.read_postings(spark, path, [*WANTED, *UNWANTED])
    return search.search_postings(postings, "comment_id", any_of=WANTED, none_of=UNWANTED)


# Inflected on purpose: stems make them meet the words of the texts.
STEMMED = fulltext.both(
    fulltext.either(fulltext.phrase("license under the apache licenses"), fulltext.phrase("MIT licensing"),
                    fulltext.prefix("killing"), fulltext.word("works")),
    fulltext.without(fulltext.word("GNU")))


INDEX_BUCKETS = 32  # a few folders suffice for the tables here; one per 100 MB or so of postings


def _index(spark, folder):
    return bindings.stored(spark, folder, "fulltext", lambda path: fulltext.write_index(
        fulltext.positional_postings(bindings.texts(spark, folder), "message", "comment_id"), path, INDEX_BUCKETS))


@query
def text_stems(spark, folder):
    """The dictionary of the stored index: every distinct term with its stem."""
    return spark.read.parquet(f"{_index(spark, folder)}/terms").select("term", "stem")


@query
def stemmed_search(spark, folder):
    found = fulltext.find(bindings.texts(spark, folder), "message", STEMMED)
    return found.select("comment_id", "post_id", "message")


@query
def stemmed_search_index(spark, folder):
    """The same search answered by the stored index alone."""
    return fulltext.find_in_index(spark, _index(spark, folder), "comment_id", STEMMED, INDEX_BUCKETS)


# --- lists -----------------------------------------------------------------------------------


def _newest(spark, folder, limit, sentiments=None, toxic_only=False):
    rows = bindings.results(spark, folder)
    scored, texts = rows.drop("comment", "cleaned_comment"), rows.select("comment_id", "comment")
    return listings.newest_with_text(scored, texts, limit, sentiments, toxic_only)


@query
def recent_comments(spark, folder):
    return listings.recent_comments(_newest(spark, folder, 100))


@query
def recent_comments_filtered(spark, folder):
    chosen = (["negative", "neutral"], True)
    return listings.recent_filtered(_newest(spark, folder, 50, *chosen), 50, *chosen)


@query
def recent_toxic(spark, folder):
    return listings.recent_toxic(_newest(spark, folder, 20, None, True), 20)


@query
def page_slice(spark, folder):
    return listings.row_range(bindings.texts(spark, folder), "doc_id", 50, 60).select("doc_id", "comment_id", "message")


@query
def display_projection(spark, folder):
    return listings.display(listings.recent_filtered(_newest(spark, folder, 50), 50))


# --- copies, pages, merge, retention, counters ------------------------------------------------


@query
def dedup_first_seen(spark, folder):
    """The first comment of each distinct text."""
    rows = bindings.comments(spark, folder).select("message", "comment_id", "ingestion_time", "doc_id")
    return records.first_texts(rows, "message", ["ingestion_time", "doc_id"])


@query
def union_pages(spark, folder):
    """Comments and conversation turns as pages of one result."""
    turns = bindings.table(spark, folder, "conversations").select(
        F.concat_ws("_", F.lit("t"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("comment_id"),
        F.concat(F.lit("conversation_"), F.col("conv_id").cast("string")).alias("post_id"),
        F.col("role").alias("username"), F.col("text").alias("message"),
    )
    page = bindings.comments(spark, folder).select("message", "username", "post_id", "comment_id")
    return records.union_pages(page, turns)


def _merge_inputs(spark, folder):
    """Stored rows up to a moment; the raw comments that later versions are made of."""
    stored = bindings.results_until(spark, folder).select(*bindings.RESULT)
    return stored, bindings.comments(spark, folder).withColumnRenamed("username", "user")


def _minimal(raw, keep=()):
    return stages.minimal_record(raw, F.col("created_time") + hours(2), keep)


def _two_versions(raw):
    """A batch with two later versions of every comment. Each comment is read once and both leave the same task, where a merge
    shrinks them to one row before any text moves. The quick one comes last: of versions without a time the last one counts."""
    kept = raw.withColumn("_raw", F.struct(*raw.columns))
    quick = stages.quick_record(kept, F.col("created_time") + hours(1), keep=("_raw",))
    both = _minimal(quick.select(F.struct(*bindings.RESULT).alias("_quick"), "_raw.*"), keep=("_quick",))
    return both.select(F.inline(F.array(F.struct(*bindings.RESULT), "_quick")))


KEY_BUCKETS = 8  # for the tables here; one per few hundred MB


def _merged_view(df):
    return df.select(
        "comment_id", "username", "cleaned_comment", fixed("toxicity_score", 6).alias("toxicity_score"), "label",
        "is_toxic", "sentiment", fixed("sentiment_score", 6).alias("sentiment_score"), "word_count", "created_time",
        "ingestion_time",
    )


@query
def upsert_results(spark, folder):
    stored, raw = _merge_inputs(spark, folder)
    return _merged_view(merge.upsert(stored, _two_versions(raw)))


@query
def upsert_scores_only(spark, folder):
    stored, raw = _merge_inputs(spark, folder)
    return _merged_view(merge.upsert(stored, _minimal(raw), update=merge.SCORE_ONLY_COLUMNS))


@query
def upsert_keyed_table(spark, folder):
    """The same merge into a stored keyed table: only touched buckets are rewritten, the stored version stays as it is."""
    stored, raw = _merge_inputs(spark, folder)
    path = bindings.stored(spark, folder, "keyed", lambda path: keyed.merge(spark, path, stored, buckets=KEY_BUCKETS))
    after = keyed.merge(spark, path, _two_versions(raw), base=0)
    return _merged_view(keyed.read(spark, path, stored.schema, after))


def _stored_statistics(spark, folder):
    """Hourly and daily statistics, the hourly ones as real-time snapshots, one without a time."""
    rows = bindings.results(spark, folder)
    hourly = rollups.period_statistics(rows, "hourly").withColumn("period_type", F.lit("realtime"))
    unknown = F.col("total_comments") == 1
    hourly = hourly.withColumn("timestamp", F.when(~unknown, F.col("timestamp")))
    return hourly.unionByName(rollups.period_statistics(rows, "daily"))


SNAPSHOTS = ("2024-01-05 06:00:00", "2024-01-08 12:30:00", "2024-01-10 00:00:00")


@query
def statistics_table(spark, folder):
    """Snapshots of the last five minutes at three moments and of each day, appended twice to a statistics table."""
    path = session.run_folder(spark, "statistics")
    rows = bindings.results(spark, folder)
    for _ in range(2):
        for at in SNAPSHOTS:
            statistics.append(rollups.realtime_statistics(rows, moment(at)), path)
        statistics.append(rollups.period_statistics(rows, "daily"), path)
    return statistics.read(spark, path)


def _after_retention(spark, folder):
    """A statistics table after retention, and the number of rows that went."""
    path = session.run_folder(spark, "statistics")
    statistics.append(_stored_statistics(spark, folder), path)
    return path, statistics.retain(spark, path, datetime(2024, 1, 14), 5)


@query
def retention_cleanup(spark, folder):
    path, _ = _after_retention(spark, folder)
    return statistics.read(spark, path).select("timestamp", "total_comments", "toxic_count", "period_start", "period_type")


@query
def retention_deleted(spark, folder):
    return spark.createDataFrame([(_after_retention(spark, folder)[1],)], "deleted_count bigint")


@query
def collector_metrics(spark, folder):
    """Five metrics of a collecting run over all comments; of the runtime only that there was one."""
    path = session.run_folder(spark, "collected")
    rows = bindings.texts(spark, folder).select(
        F.md5("message").alias("content_key"), F.when(F.col("doc_id") % 7 != 0, F.col("message")).alias("message"), "doc_id")
    collecting.collect_run(rows, "message", "content_key", ["doc_id"], path, f"{path}-metrics", datetime(2024, 1, 10))
    value = F.when(F.col("metric_name") == "runtime_seconds", (F.col("metric_value") > 0).cast("double")).otherwise(F.col("metric_value"))
    return spark.read.schema(schemas.METRICS).parquet(f"{path}-metrics").withColumn("metric_value", value)


@query
def run_counters(spark, folder):
    """Collector counters over all comments, keyed by their text; every seventh came blank."""
    rows = bindings.texts(spark, folder).select(
        F.md5("message").alias("content_key"),
        F.when(F.col("doc_id") % 7 != 0, F.col("message")).alias("message"),
    )
    return rollups.run_counters(rows, "message", "content_key", bindings.as_of())
