"""Every operator as a query over the bench tables: ``name -> callable(spark, folder)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.functions import cleaners as C
from dxweave.functions import text as X
from dxweave.operators import candidates
from dxweave.operators import cascade as K
from dxweave.operators import inspection as I
from dxweave.operators import lookup as L
from dxweave.operators import pairs as P
from dxweave.operators import repair as G
from dxweave.operators import resume as R
from dxweave.operators import schema as S
from dxweave.operators import statistics as T
from dxweave.operators import usage as U
from dxweave.operators.dedup import first_per_key, last_per_key, one_per_key
from dxweave.plans import bindings as B
from dxweave.plans.audit import audit
from dxweave.plans.cleaning import clean_table
from dxweave.session import materialize, shared_dir
from dxweave.sources import readers, writers
from dxweave.streaming.incremental import run_incremental_coding, term_cache
from dxweave.streaming.usage_stream import current_totals, run_usage_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- inspection ---------------------------------------------------------------


def _annotated(spark: SparkSession, folder: str) -> DataFrame:
    return P.annotate_cells(B.noisy_cells(spark, folder))


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return P.cell_pairs(_annotated(spark, folder))


@query
def term_code_stats(spark, folder):
    return P.ordered_stats(P.term_code_stats(_pairs(spark, folder)))


@query
def reverse_map(spark, folder):
    return P.reverse_map(_pairs(spark, folder))


@query
def reverse_report(spark, folder):
    report = P.reverse_report(_pairs(spark, folder))
    return report.select("code", "part", F.to_json("terms").alias("terms"))


@query
def recommended_codes(spark, folder):
    return P.global_recommendation(_pairs(spark, folder))


@query
def multi_code_conflicts(spark, folder):
    return I.conflict_flags(_pairs(spark, folder)).select(*I.FLAG_COLUMNS)


@query
def running_recommendation(spark, folder):
    return P.running_recommendation(_pairs(spark, folder), chunk_records=1000)


@query
def flags_cells(spark, folder):
    return I.cell_flags(_annotated(spark, folder)).select(*I.FLAG_COLUMNS)


@query
def inspection_flags(spark, folder):
    return I.ordered_flags(I.all_flags(B.noisy_cells(spark, folder)))


@query
def inspection_summary(spark, folder):
    return I.flag_summary(I.all_flags(B.noisy_cells(spark, folder)))


@query
def fix_rule_template(spark, folder):
    return I.rule_template(I.all_flags(B.noisy_cells(spark, folder)))


# -- text and cleaning --------------------------------------------------------


@query
def normalize_terms(spark, folder):
    norms = B.document_lines(spark, folder).select("doc_id", "pos", X.normalize_term(F.col("line")).alias("norm"))
    return norms.select("doc_id", "pos", "norm", X.noise_reason(F.col("norm")).alias("reason"))


@query
def depth_split(spark, folder):
    documents = B.bracketed_documents(spark, folder)
    return documents.select("doc_id", F.posexplode(X.depth_split(F.col("text"))).alias("pos", "part"))


@query
def clean_terms(spark, folder):
    documents = B.bracketed_documents(spark, folder)
    return documents.select("doc_id", C.clean_diagnosis(F.col("text"), B.DOCUMENT_PACK).alias("terms"))


@query
def clean_columns(spark, folder):
    cleaned = clean_table(B.noisy_records(spark, folder).select("record_id", "diagnosis1", "diagnosis2"))
    return cleaned


@query
def connector_split(spark, folder):
    lines = B.document_lines(spark, folder)
    chunks = X.connector_split(F.col("line"), B.WORD_PACK)
    return lines.select("doc_id", "pos", F.array_join(chunks, "|").alias("chunks"))


@query
def marker_split(spark, folder):
    documents = B.text_table(spark, folder, "documents")
    return documents.select("doc_id", C.clean_risk(F.col("text"), B.DOCUMENT_RISK_PACK).alias("terms"))


@query
def legacy_plain(spark, folder):
    documents = B.bracketed_documents(spark, folder)
    return documents.select("doc_id", C.clean_diagnosis_plain(F.col("text"), B.DOCUMENT_PACK).alias("terms"))


@query
def legacy_complications(spark, folder):
    cells = B.complication_cells(spark, folder)
    return cells.select("p_partkey", C.clean_complication(F.col("cell")).alias("terms"))


@query
def legacy_protected(spark, folder):
    cells = B.indication_cells(spark, folder)
    return cells.select("p_partkey", C.clean_indication(F.col("cell")).alias("terms"))


@query
def strip_html(spark, folder):
    return B.text_table(spark, folder, "pages").select("page_id", X.strip_html(F.col("html")).alias("plain"))


@query
def extract_json(spark, folder):
    replies = B.reply_texts(spark, folder).select(
        "p_partkey", X.extract_json(F.col("reply")).alias("document"), X.verdict_code(F.col("reply")).alias("code")
    )
    number = X.safe_int(F.get_json_object("document", "$.n"))
    return replies.select("p_partkey", "document", "code", number.alias("n"))


# -- layout -------------------------------------------------------------------


@query
def row_ordinal(spark, folder):
    events = B.table(spark, folder, "events")
    return S.with_row_ordinal(events, "ordinal").select("ordinal", "event_id")


@query
def record_terms(spark, folder):
    return S.terms_long(B.noisy_records(spark, folder), ["diagnosis1", "diagnosis2"])


@query
def record_round_trip(spark, folder):
    records = B.uncoded_records(spark, folder)
    columns = S.term_columns(records.columns)
    terms = S.terms_long(records, columns).withColumn("code", F.col("term"))
    back = S.attach_cells(records, terms, columns)
    return back.select("record_id", *[F.col(c + "_ICD11_Code").alias(c) for c in columns])


# -- lookups and rules --------------------------------------------------------


@query
def rule_set_version(spark, folder):
    lines = B.table(spark, folder, "part").select(
        "p_type", F.col("p_partkey").alias("line"), F.col("p_name").alias("term"), F.col("p_brand").alias("code")
    )
    return K.rule_set_version(lines, ["p_type"])


@query
def dictionary_last_wins(spark, folder):
    return last_per_key(B.part_dictionary(spark, folder), ["term"], "line")


@query
def rules_first_wins(spark, folder):
    return first_per_key(B.part_dictionary(spark, folder), ["term", "code"], "line")


@query
def dictionary_map(spark, folder):
    book = last_per_key(B.part_dictionary(spark, folder), ["term"], "line").select("term", "code")
    lines = B.record_lines(spark, folder).select("record_id", F.col("place.*"), F.col("p_name").alias("term"))
    return L.dictionary_lookup(lines, book)


@query
def context_rules(spark, folder):
    mapped = L.code_risk_items(B.order_risks(spark, folder), B.order_dictionary(spark, folder), B.ORDER_RULES)
    return mapped.select("record_id", F.col(V.RISK_COLUMN + V.CODE_SUFFIX).alias("risk_codes"))


# -- coding cascade -----------------------------------------------------------


def _blank_to_null(name: str):
    return F.when(F.col(name) != "", F.col(name)).alias(name)


@query
def code_cascade(spark, folder):
    cache, rules, resolvers = B.cascade_inputs(spark, folder)
    records = B.uncoded_records(spark, folder)
    coded, _ = K.code_table(records, S.term_columns(records.columns), resolvers, cache, rules)
    return coded.select("record_id", *[_blank_to_null(f"diagnosis{i}_ICD11_Code") for i in (1, 2)])


def _coded_terms(spark, folder):
    cache, rules, resolvers = B.cascade_inputs(spark, folder)
    terms = B.record_lines(spark, folder).select(B.coded_term().alias("term"))
    return K.code_terms(terms, resolvers, cache, rules)


@query
def coded_terms(spark, folder):
    return _coded_terms(spark, folder)


@query
def cache_additions(spark, folder):
    return K.cache_additions(_coded_terms(spark, folder))


@query
def recorded_candidates(spark, folder):
    _, _, resolvers = B.cascade_inputs(spark, folder)
    words = B.table(spark, folder, "part").select(F.explode(F.split("p_name", " ")).alias("sub_term")).distinct()
    found = words.join(one_per_key(resolvers.candidates(words), ["sub_term"]), "sub_term")
    rows = found.select("sub_term", F.posexplode("candidates").alias("pos", "c"))
    return rows.select("sub_term", (F.col("pos") + 1).alias("rank"), "c.code", "c.title", "c.chapter")


@query
def candidate_topk(spark, folder):
    lines = B.document_lines(spark, folder).select(F.col("line").alias("sub_term"))
    return candidates.search(lines, B.search_catalogue(spark, folder), hot=16)


# -- resume -------------------------------------------------------------------


def _result_parts(spark, folder):
    """Two result parts that overlap; the later one wins."""
    orders = B.table(spark, folder, "orders").select(F.col("o_orderkey").alias("record_id"), "o_orderpriority", "o_orderstatus")

    def part(condition, value):
        cells = F.create_map(F.lit("diagnosis1"), value, F.lit("diagnosis2"), F.col("o_orderstatus"))
        return orders.filter(condition).select("record_id", cells.alias("results"))

    return [
        part(F.col("record_id") % 2 == 0, F.col("o_orderpriority")),
        part(F.col("record_id") % 3 == 0, F.concat(F.lit("later "), "o_orderpriority")),
    ]


@query
def merge_resume(spark, folder):
    merged = R.merge_parts(_result_parts(spark, folder))
    orders = B.table(spark, folder, "orders").select(F.col("o_orderkey").alias("record_id"))
    return R.merge_results(orders, merged, ["diagnosis1", "diagnosis2"])


@query
def resume_unfinished(spark, folder):
    first, second = _result_parts(spark, folder)
    finished = first.select("record_id").union(second.select("record_id"))
    return R.unfinished(B.table(spark, folder, "orders").withColumnRenamed("o_orderkey", "record_id"), finished).select(
        "record_id", "o_orderpriority"
    )


# -- repair -------------------------------------------------------------------


def _changes(spark, folder):
    return G.rule_changes(B.noisy_cells(spark, folder), G.load_rules(B.repair_rules(spark, folder)))


@query
def repair_rule_set(spark, folder):
    return G.load_rules(B.repair_rules(spark, folder))


@query
def apply_fix_rules(spark, folder):
    return _changes(spark, folder)


@query
def fix_summary(spark, folder):
    return G.change_summary(_changes(spark, folder))


@query
def repaired_records(spark, folder):
    fixed, _ = G.repair(B.noisy_records(spark, folder), B.repair_rules(spark, folder))
    return fixed.select("record_id", *[_blank_to_null(f"diagnosis{i}_ICD11_Code") for i in (1, 2)])


@query
def noise_free_records(spark, folder):
    records = B.noisy_records(spark, folder)
    none = B.repair_rules(spark, folder).filter(F.col("rule_no") < 0)
    fixed, _ = G.repair(records, none, drop_noise=True)
    names = [f"diagnosis{i}{s}" for i in (1, 2) for s in ("", "_ICD11_Code")]
    return fixed.select("record_id", *[_blank_to_null(n) for n in names])


CODE_COLUMNS = ["diagnosis1_ICD11_Code", "diagnosis2_ICD11_Code"]


@query
def global_replace_one(spark, folder):
    """Codes that only begin like the one asked for stay, and so does odd spacing around them."""
    records = B.clean_records(spark, folder)
    odd = F.concat(F.lit(" "), F.replace(F.col(CODE_COLUMNS[1]), F.lit("|"), F.lit(" | ")))
    records = records.withColumn(CODE_COLUMNS[1], F.when(F.col("record_id") % 2 == 0, odd).otherwise(F.col(CODE_COLUMNS[1])))
    replaced = G.replace_code(records, CODE_COLUMNS, "Brand#21", "Brand#2/X")
    return replaced.select("record_id", *[_blank_to_null(c) for c in CODE_COLUMNS])


@query
def global_replace_table(spark, folder):
    # One row for each part: many for a code, of which the last counts.
    parts = B.table(spark, folder, "part").filter(F.col("p_brand").endswith("2"))
    new = F.concat("p_brand", F.lit("-"), F.col("p_partkey").cast("string"))
    mapping = parts.select(F.col("p_partkey").alias("line"), F.col("p_brand").alias("old_code"), new.alias("new_code"))
    replaced = G.replace_codes(B.clean_records(spark, folder), CODE_COLUMNS, mapping)
    return replaced.select("record_id", *[_blank_to_null(c) for c in CODE_COLUMNS])


@query
def sample_query(spark, folder):
    cells = B.noisy_cells(spark, folder)
    asked = {"code": {"code": "Brand#12"}, "keyword": {"keyword": "anvil"}, "both": {"code": "Brand#12", "keyword": "anvil"}}
    found = [G.find_samples(cells, **k).withColumn("asked", F.lit(name)) for name, k in asked.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


# -- statistics ---------------------------------------------------------------


def _prevalence(**switches):
    def run(spark, folder):
        records = B.parity_records(spark, folder)
        columns = S.code_columns(records.columns, ["diagnosis1", "diagnosis2", "diagnosis3"])
        return T.ordered_prevalence(T.prevalence(records, columns, B.STATISTICS_PACK, **switches))

    return run


QUERIES["code_prevalence"] = _prevalence()
QUERIES["code_prevalence_with_groups"] = _prevalence(enable_groups=True)
QUERIES["code_prevalence_ungrouped"] = _prevalence(enable_groups=True, only_ungrouped=True)
QUERIES["code_prevalence_groups_only"] = _prevalence(enable_groups=True, keep_individual=False)


@query
def prefix_groups(spark, folder):
    part = B.table(spark, folder, "part")
    rules = part.groupBy(F.left("p_brand", F.lit(7)).alias("prefix")).agg(F.min("p_partkey").alias("rank"))
    exact = part.groupBy(F.col("p_brand").alias("prefix")).agg(F.max("p_partkey").alias("rank"))
    table = rules.unionByName(exact.filter(F.char_length("prefix") > 7)).withColumn("label", F.concat(F.lit("group "), "prefix"))
    return T.prefix_groups(part.select(F.col("p_brand").alias("code")), table)


# -- usage and streams --------------------------------------------------------


@query
def usage_summary(spark, folder):
    return U.usage_summary(B.usage_calls(B.table(spark, folder, "events")))


@query
def usage_stream(spark, folder):
    events = B.table(spark, folder, "events")
    stream = spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    out = shared_dir(spark, "usage")
    run_usage_stream(B.usage_calls(stream), f"{out}/totals", f"{out}/checkpoint").awaitTermination()
    changes = spark.read.parquet(f"{out}/totals")
    return current_totals(changes)


@query
def incremental_coding(spark, folder):
    cache, rules, resolvers = B.cascade_inputs(spark, folder)
    out = shared_dir(spark, "coding")
    records = B.uncoded_records(spark, folder)
    records.write.parquet(f"{out}/records")
    lines = rules.select(F.lit(0).alias("line"), "term", "code")
    key = K.cache_name("recorded", K.rule_set_version(lines).first()["version"])
    term_cache(f"{out}/cache", key).append(cache, -1)
    stream = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 2).parquet(f"{out}/records")
    run_incremental_coding(
        stream, S.term_columns(records.columns), resolvers,
        out=f"{out}/coded", cache=f"{out}/cache", checkpoint=f"{out}/checkpoint", rules=rules, cache_key=key,
    ).awaitTermination()
    coded = spark.read.parquet(f"{out}/coded")
    return coded.select("record_id", *[_blank_to_null(c) for c in CODE_COLUMNS])


# -- files --------------------------------------------------------------------


@query
def csv_round_trip(spark, folder):
    """Written in order and read again: NA spellings, quotes and line breaks inside cells, row numbers."""
    path = shared_dir(spark, "csv")
    writers.write_table(B.csv_cells(spark, folder), path, ["part"])
    return readers.read_table(spark, path, multi_line=True, ordinal="row").select("row", "part", "diagnosis1")


@query
def kept_output(spark, folder):
    """A second table for the same place is refused, and the first stays as it was."""
    path = shared_dir(spark, "kept")
    cells = B.csv_cells(spark, folder)
    writers.write_table(cells, path, ["part"])
    try:
        writers.write_table(cells.select("part"), path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    else:
        raise AssertionError(f"{path} was written twice")
    return readers.read_table(spark, path, multi_line=True, ordinal="row").select("row", "part", "diagnosis1")


@query
def dictionary_file(spark, folder):
    path = shared_dir(spark, "dictionary")
    B.two_column_file(B.part_dictionary(spark, folder), path)
    return readers.read_dictionary(spark, path)


@query
def rule_file(spark, folder):
    """The first row names its columns and is no rule."""
    path = shared_dir(spark, "rules")
    header = spark.range(1).select(F.lit(-1).cast("bigint").alias("line"), F.lit("term").alias("term"), F.lit("ICD code").alias("code"))
    B.two_column_file(B.part_dictionary(spark, folder).unionByName(header), path)
    return readers.exact_rules(readers.read_rule_lines(spark, path))


@query
def term_log(spark, folder):
    """A log to which two runs append, the second only what is new, with broken lines between."""
    path = shared_dir(spark, "log")
    entries = B.part_dictionary(spark, folder).select(F.col("term").alias("key"), F.col("code").alias("value"), "line")
    writers.append_new(entries.filter(F.col("line") % 16 == 0), path, "key", "line")
    entries.select(F.concat(F.lit('{"key": "'), "key").alias("value")).write.mode("append").text(path)
    writers.append_new(entries, path, "key", "line")
    return readers.read_log(spark, path, "key")


@query
def archived_columns(spark, folder):
    cells = B.legacy_cells(spark, folder)
    cleaned = clean_table(cells, "archived").select("p_partkey", V.INDICATION_COLUMN, V.COMPLICATION_COLUMN, V.RISK_COLUMN)
    alone = clean_table(clean_table(cells, "risks"), "indications").select(
        "p_partkey", F.col(V.INDICATION_COLUMN).alias("indication_alone"), F.col(V.RISK_COLUMN).alias("risk_alone")
    )
    names = {V.INDICATION_COLUMN: "indication", V.COMPLICATION_COLUMN: "complication", V.RISK_COLUMN: "risk"}
    return cleaned.withColumnsRenamed(names).join(alone, "p_partkey")


@query
def risk_backfill(spark, folder):
    """Records without one of the context columns: it is filled in, and no row is lost."""
    records = B.order_risks(spark, folder).drop(V.COMPLICATION_COLUMN)
    mapped = L.code_risk_items(S.backfill(records, [V.COMPLICATION_COLUMN]), B.order_dictionary(spark, folder), B.ORDER_RULES)
    mapped = materialize(mapped, "risks")
    L.assert_same_height(records, mapped)
    return mapped.select("record_id", F.col(V.RISK_COLUMN + V.CODE_SUFFIX).alias("risk_codes"))


@query
def searched_cascade(spark, folder):
    """Every term is split, searched in a catalogue, and takes the first candidate."""
    part = B.table(spark, folder, "part")
    catalogue = part.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("code"), F.col("p_name").alias("title"))
    splits = part.select(
        B.coded_term().alias("term"), F.concat(F.lit('{"english_terms": ["'), "p_name", F.lit('"]}')).alias("reply")
    ).distinct()
    resolvers = K.Resolvers(
        splits=K.recorded(splits),
        candidates=lambda subs: candidates.as_candidates(candidates.search(subs, catalogue), catalogue),
    )
    return K.code_terms(part.select(B.coded_term().alias("term")), resolvers)


@query
def audit_loop(spark, folder):
    fixed, _ = audit(B.noisy_records(spark, folder))
    return fixed.select("record_id", *[_blank_to_null(c) for c in CODE_COLUMNS])
