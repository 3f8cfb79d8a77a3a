"""Loss-history linkage: claim sheets matched to a request list and merged with a claims master."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import account_name_of, ascii_fold, match_key_of, token_key_of
from millrace.operators.filters import within_lookback
from millrace.operators.fuzzy import fuzzy_best
from millrace.operators.joins import choose_key, coalesce_pairs, merge_outer
from millrace.operators.ranges import match_null_safe
from millrace.operators.ranking import keep_last
from millrace.operators.setops import union_by_name
from millrace.operators.shape import conform
from millrace.schemas import claim_sheet, loss_history
from millrace.session import kept
from millrace.sources.files import files_to_rows

MATCH = "ENTITY_FOR_TEXT_MATCHING"
# Columns of the sheet layout that come from the message or the run, not from the file.
NAMED = ("EMAIL_FULL_SUBJECT_LINE", "ENTITY", "ENTITY_FROM_EMAIL_SUBJECT_LINE", "ENTITY_FOR_TEXT_MATCHING")  # what follows from subject and entity
DERIVED = ("EMAIL_FULL_SUBJECT_LINE", "ENTITY_FROM_EMAIL_SUBJECT_LINE", "ENTITY_FOR_TEXT_MATCHING", "RECORD_INSERTION_DATE")
MERGE_KEYS = ["CLM_IDNTFR_JOIN_KEY", "ACCIDENT_DATE", "TERM_EFFCTV_DATE", "VALUATION_DATE"]

# Output column to its sources by priority, after the merge.
PAIRS = {
    "POLICY_EFFECTIVE_DATE": ["POLICY_EFFECTIVE_DATE_x", "POLICY_EFFECTIVE_DATE_y"],
    "POLICY_EXPIRATION_DATE": ["POLICY_EXPIRATION_DATE_x", "POLICY_EXPIRATION_DATE_y"],
    "PRODUCT": ["PRODUCT", "PRDCT_SHRT_NAME"],
    "CARRIER": ["CARRIER", "CRRNT_CRRR_ORGNZTN_NAME"],
    "CLAIM_STATUS": ["CLAIM_STATUS", "CLM_STTS_INDCTR"],
    "ACCIDENT_DESCRIPTION_DETAILS": ["ACCIDENT_DESCRIPTION_DETAILS", "ACCDNT_DSCRPTN"],
    "TOTAL_INCURRED": ["TOTAL_INCURRED", "TTL_INCRRD_AMNT"],
    "ACCIDENT_STATE": ["ACCIDENT_STATE", "STT_ABBRVTN"],
    "NEW_RENEWAL": ["NEW_RENEWAL", "CNSMR_RQST_DSCRPTN"],
    "STATUS": ["STATUS", "STTS_NAME"],
    "CLM_IDNTFR": ["CLAIM_NUMBER", "CLAIMANT_NAME", "CLM_IDNTFR"],
}


def clean_names(raw: DataFrame, subject: str) -> tuple[DataFrame, DataFrame]:
    """(subject, ENTITY, id) of every different pair, and the columns ``NAMED`` of every id: the cleaners run once per name, not once per row.

    Pairs that give the same columns have one id, so it stands for them where rows are compared.
    """
    names = kept(raw.select(F.col(subject).alias("__subject"), F.col("ENTITY").cast("string").alias("__entity")).distinct())
    found = kept(names.withColumn("__name", F.coalesce(account_name_of(F.col("__subject")), F.col("__entity"))))
    found = ascii_fold(found.select(
        "__subject", "__entity", F.upper("__subject").alias("EMAIL_FULL_SUBJECT_LINE"), F.col("__entity").alias("ENTITY"),
        F.col("__name").alias("ENTITY_FROM_EMAIL_SUBJECT_LINE"), match_key_of(F.col("__name")).alias(MATCH),
    ), list(NAMED))
    found = kept(found)
    texts = kept(found.select(*NAMED).distinct().withColumn("__id", F.monotonically_increasing_id()))
    return match_null_safe(found, texts, list(NAMED)).select("__subject", "__entity", "__id"), texts


def tag_sheets(raw: DataFrame, subject: str, received: str, inserted: Column, extra: list[str] = ()) -> DataFrame:
    """Columns derived from the message a sheet came with, then the declared sheet layout and the columns ``extra`` as they are.

    ``raw`` has sheet columns by normalised name plus the ``subject`` and ``received`` date.
    """
    names, texts = clean_names(raw, subject)
    same = F.col(subject).eqNullSafe(F.col("__subject")) & F.col("ENTITY").cast("string").eqNullSafe(F.col("__entity"))
    named = raw.join(kept(names), same, "left").withColumns({
        "RECORD_INSERTION_DATE": inserted.cast("date"),
        "VALUATION_DATE": F.coalesce(F.col("VALUATION_DATE").cast("string"), F.col(received).try_cast("date").cast("string")),
    }).drop("ENTITY")
    layout = T.StructType([*claim_sheet().fields, *[raw.schema[c] for c in extra]])
    # Columns that the input lacks are null in every row, and the id stands for the texts, so duplicates are told by the others alone.
    had = {c.upper() for c in named.columns}
    filled = T.StructType([*[f for f in layout.fields if f.name.upper() in had], T.StructField("__id", T.LongType())])
    return conform(conform(named, filled).dropDuplicates().join(texts, "__id"), layout, fold=False)


def request_list(requests: DataFrame) -> DataFrame:
    """Newest request per (match key, term start). Input: account_name, term_effctv_date, mdfd_date, status, new_renewal."""
    keyed = requests.select(
        match_key_of(F.col("account_name")).alias(MATCH),
        F.col("account_name").alias("ACCOUNT_NAME"), F.col("term_effctv_date").cast("date").alias("TERM_EFFCTV_DATE"),
        F.col("new_renewal").alias("NEW_RENEWAL"), F.col("status").alias("STATUS"), F.col("mdfd_date").alias("MDFD_DATE"),
    )
    return keep_last(keyed, [MATCH, "TERM_EFFCTV_DATE"], ["MDFD_DATE"], ["ACCOUNT_NAME", "STATUS", "NEW_RENEWAL"])


def entity_matches(sheets: list[DataFrame], requests: DataFrame, min_score: int = 90) -> DataFrame:
    """(key, matched): for every match key in the sheets the request key it fits best.

    A key is cleaned once more before matching, as a stored key may predate the cleaner.
    """
    # Kept: the distinct keys are few beside the sheets, and cleaning must not be replanned into the ingest.
    keys = kept(union_by_name(*[s.select(F.col(MATCH).alias("__key")) for s in sheets]).distinct())
    cleaned = keys.select("__key", match_key_of(F.col("__key")).alias("__clean"))
    return kept(fuzzy_best(cleaned, requests, "__clean", MATCH, min_score).select("__key", "matched"))


def match_entities(sheets: DataFrame, matches: DataFrame) -> DataFrame:
    """Replace each sheet's match key by the request key found for it, null if none was."""
    joined = sheets.withColumnRenamed(MATCH, "__key").join(matches, "__key", "left")
    return joined.withColumnRenamed("matched", MATCH).drop("__key")


def attach_requests(new: DataFrame, old: DataFrame, requests: DataFrame, today: Column, min_score: int = 90) -> DataFrame:
    """New sheets with their requests (or none), and old sheets that have one, cut to the year before the term."""
    claim = [MATCH, "CLAIM_NUMBER", "ACCIDENT_DATE", "POLICY_EFFECTIVE_DATE"]
    rest = [c for c in claim_sheet().names if c not in (*claim, "VALUATION_DATE")]
    matches = entity_matches([new, old], requests, min_score)
    now = match_entities(new, matches).join(requests, MATCH, "left")
    before = (
        match_entities(keep_last(old, claim, ["VALUATION_DATE"], rest), matches)
        .join(requests, MATCH, "inner").withColumn("RECORD_INSERTION_DATE", today.cast("date"))
    )
    recent = within_lookback(union_by_name(now, before), "VALUATION_DATE", "TERM_EFFCTV_DATE", 365)
    ties = [c for c in recent.columns if c not in (*claim, "TERM_EFFCTV_DATE", "VALUATION_DATE")]
    return keep_last(recent, [*claim, "TERM_EFFCTV_DATE"], ["VALUATION_DATE"], ties)


def merge_master(sheets: DataFrame, master: DataFrame) -> DataFrame:
    """Full outer merge of sheets and claims master, columns coalesced by priority, in the history layout."""
    known = master.withColumnsRenamed({
        "PLAN_EFFCTV_DATE": "POLICY_EFFECTIVE_DATE", "PLAN_EXPRTN_DATE": "POLICY_EXPIRATION_DATE",
        "ACCDNT_DATE": "ACCIDENT_DATE", "VLTN_DATE": "VALUATION_DATE",
    }).withColumn("IS_MASTER", F.lit(1))
    # The sheets are ASCII already; folding the master here leaves nothing to fold after the merge.
    known = ascii_fold(known, [c for c, t in known.dtypes if t == "string"])
    key = ["CLM_IDNTFR", "ACCIDENT_DATE", "POLICY_EFFECTIVE_DATE", "TERM_EFFCTV_DATE"]
    ties = [c for c in known.columns if c not in (*key, "VALUATION_DATE")]
    known = keep_last(known, key, ["VALUATION_DATE"], ties).withColumn("CLM_IDNTFR_JOIN_KEY", token_key_of(F.col("CLM_IDNTFR")))
    known = kept(known)
    ours = choose_key(sheets.withColumn("IS_SHEET", F.lit(1)), known, "CLM_IDNTFR", "CLAIM_NUMBER", "CLAIMANT_NAME", "__claim")
    ours = ours.withColumn("CLM_IDNTFR_JOIN_KEY", token_key_of(F.col("__claim"))).drop("__claim")
    # Each side is read two or three times by the merge and is expensive to make again.
    both = merge_outer(kept(ours), known, MERGE_KEYS)
    final = F.upper(F.coalesce("ORGNZTN_NAME", "ENTITY", "ENTITY_FROM_EMAIL_SUBJECT_LINE"))
    return conform(coalesce_pairs(both.withColumn("ENTITY_FINAL", final), PAIRS, drop=False), loss_history(), fold=False)


def loss_history_linkage(new: DataFrame, old: DataFrame, requests: DataFrame, master: DataFrame, today: Column,
                         min_score: int = 90) -> DataFrame:
    # Kept, as one row per name and term is few beside the sheets: of known size, it is joined without moving them.
    return merge_master(attach_requests(new, old, kept(request_list(requests)), today, min_score), master)


def history_window(last_insert: Column) -> tuple[Column, Column]:
    """Valuation dates of old sheets worth re-reading: 13 average months back to 3 ahead of the last run."""
    return F.date_sub(last_insert, 396), F.date_add(last_insert, 91)


def read_history(spark: SparkSession, home: str) -> DataFrame:
    """The history a job keeps in ``home``: the declared columns, the number of the batch and the key of the row."""
    fields = [*loss_history().fields, T.StructField("row_key", T.StringType()), T.StructField("batch", T.LongType())]
    return _read_batches(spark, f"{home}/history", T.StructType(fields))


def _read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Folders of finished batches; none if there is no batch yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def link_batch(new: DataFrame, number: int, home: str, requests: DataFrame, master: DataFrame, today: Column, min_score: int = 90) -> None:
    """Link the tagged sheets of one batch and append what they add to the history.

    The sheets join the store under the batch's number; older ones are read back only as far as ``history_window`` of the newest insertion
    date of earlier batches reaches. Rows that an earlier batch has, but for their insertion date, are not added again. Both folders
    belong to the batch, so running it again replaces what it wrote and nothing else.
    """
    spark = new.sparkSession
    new.write.mode("overwrite").parquet(f"{home}/sheets/batch={number}")
    new = spark.read.schema(claim_sheet()).parquet(f"{home}/sheets/batch={number}")
    history = read_history(spark, home).filter(F.col("batch") < number)
    mark = F.max("RECORD_INSERTION_DATE")
    low, high = (history.agg(edge).scalar() for edge in history_window(mark))
    stored = _read_batches(spark, f"{home}/sheets", T.StructType([*claim_sheet().fields, T.StructField("batch", T.LongType())]))
    old = stored.filter((F.col("batch") < number) & F.col("VALUATION_DATE").between(low, high)).drop("batch")
    linked = loss_history_linkage(new, old, requests, master, today, min_score)
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in loss_history().names if c != "RECORD_INSERTION_DATE"]
    keyed = linked.withColumn("row_key", F.sha2(F.to_json(F.array(*parts)), 256))
    keyed.join(history.select("row_key"), "row_key", "left_anti").select(*linked.columns, "row_key").write.mode("overwrite").parquet(f"{home}/history/batch={number}")


def run(spark: SparkSession, inbox: str, home: str, requests: DataFrame, master: DataFrame, today: Column, min_score: int = 90, sep: str = ",",
        archive: str | None = None) -> None:
    """Take the sheet files that came to ``inbox`` since the last run and append what they add to the history in ``home``.

    The files are a stream: its progress log is the manifest of files already taken, so a file is taken once, and a batch that was cut off is
    run again under its number. Files are delimited sheets with a header each and the columns SUBJECT and RECEIVED of the message; with
    ``archive`` taken files are moved there. Without new files nothing is written.
    """
    reader = spark.readStream.format("text").schema("value string").option("wholetext", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    files = reader.load(inbox).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))
    names = [*[c for c in claim_sheet().names if c not in DERIVED], "SUBJECT", "RECEIVED"]

    def take(batch: DataFrame, number: int) -> None:
        raw = files_to_rows(batch, names, sep)
        link_batch(tag_sheets(raw, "SUBJECT", "RECEIVED", today), number, home, requests, master, today, min_score)

    files.writeStream.foreachBatch(take).option("checkpointLocation", f"{home}/progress").trigger(availableNow=True).start().awaitTermination()


SCHEMAS: dict[str, T.StructType] = {"claim_sheet": claim_sheet(), "loss_history": loss_history()}
