"""Clinical shapes derived from the general-purpose tables of the test bench.

The tables hold no diagnoses, so each query first derives the shape its operator works
on: records with term and code cells, reply texts, dictionaries, usage logs.  Every
derivation is a deterministic formula over whole tables; the oracle applies the same one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dxweave import vocab as V
from dxweave.operators import schema as S


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Tasks that work on the bench's tables of long texts, whose files are single row groups and can't be split.
TEXT_TASKS = 32


def text_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A bench table of long texts, dealt out to a fixed number of tasks."""
    return table(spark, folder, name).repartition(TEXT_TASKS)


def record_lines(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: its record, its place in it, and the raw material."""
    part = table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    line = table(spark, folder, "lineitem")
    return line.join(part, line["l_partkey"] == part["p_partkey"]).select(
        F.col("l_orderkey").alias("record_id"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("place"),
        "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
        "p_name", "p_brand", "p_type",
    )


def noisy_term() -> Column:
    """Noise in place of a term on some lines, another spelling on others."""
    noise = (
        F.when(F.col("l_linenumber") % 3 == 0, "无")
        .when(F.col("l_linenumber") % 3 == 1, "---")
        .otherwise(")")
    )
    return (
        F.when(F.col("l_discount") == 0.1, noise)
        .when(F.col("l_tax") == 0.02, F.concat(F.lit("，"), "p_name", F.lit("（")))
        .otherwise(F.col("p_name"))
    )


def noisy_code() -> Column:
    """Missing, failed and null-word codes on some lines."""
    failed = (F.col("l_returnflag") == "R") & (F.col("l_quantity") < 5)
    return (
        F.when(F.col("l_quantity") == 50, F.lit(None).cast("string"))
        .when(failed, "ERROR: No API results")
        .when(F.col("l_tax") == 0.08, "None")
        .otherwise(F.col("p_brand"))
    )


def wide_records(lines: DataFrame, term: Column, code: Column, drop_cells: bool) -> DataFrame:
    """Records in wide layout: lines alternate between two term/code column pairs.

    ``place`` orders the lines of a record.  With ``drop_cells`` some records lose all
    their codes and some all their terms.
    """
    # Collecting whole records has nothing to combine on the map side: shuffle rows once.
    entries = lines.select(
        "record_id", "l_shipdate", F.struct("place", term.alias("term"), code.alias("code")).alias("e")
    ).repartition("record_id")
    grouped = entries.groupBy("record_id").agg(
        F.sort_array(F.collect_list("e")).alias("e"),
        F.date_format(F.min("l_shipdate"), "yyyy-MM-dd").alias("admission_date"),
    )

    def cell(parity: int, field: str, lost_every: int) -> Column:
        mine = F.filter("e", lambda _, i: i % 2 == parity)
        text = F.array_join(F.transform(mine, lambda x: x[field]), "|")
        return F.when(F.col("record_id") % lost_every != 0, text) if drop_cells else text

    return grouped.select(
        "record_id",
        F.concat(F.lit("u"), F.col("record_id").cast("string")).alias("uuid"),
        "admission_date",
        *[
            cell(parity, field, lost).alias(f"diagnosis{parity + 1}{suffix}")
            for parity in (0, 1)
            for field, lost, suffix in (("term", 19, ""), ("code", 17, V.CODE_SUFFIX))
        ],
    )


def noisy_records(spark: SparkSession, folder: str) -> DataFrame:
    return wide_records(record_lines(spark, folder), noisy_term(), noisy_code(), True)


def clean_records(spark: SparkSession, folder: str) -> DataFrame:
    """Term and code on every line."""
    return wide_records(record_lines(spark, folder), F.col("p_name"), F.col("p_brand"), False)


def noisy_cells(spark: SparkSession, folder: str) -> DataFrame:
    records = noisy_records(spark, folder)
    return S.pair_cells(records, S.code_pairs(records.columns))


# -- documents as free-text cells ---------------------------------------------

# A small English/French/Spanish/German pack for the document cells.
DOCUMENT_PACK = V.DiagnosisVocab(
    separators=",;|?!\n\r\t",
    stop_terms=("", "is", "le", "the", "%%%", "***"),
    drop_patterns=(r"\p{Lu}\p{Ll}+", r"(?:on|in) .*", r".* ed"),
    drop_keyword="with",
    keep_patterns=(r".*with of.*", r"with .*"),
    leading_words=("Is", "The"),
    phrases=(" that ", "rewh"),
    connectors=(" and ", " et ", " y ", " und "),
    lexicon=(" and the",),
    squeeze_chunks=False,
)
DOCUMENT_RISK_PACK = V.RiskVocab(
    marker_pattern="[.,] ", prefixes=("the ", "de ", "on "), stop_terms=("is", "le", "der")
)
WORD_PACK = V.DiagnosisVocab(
    stop_terms=("", "is", "a"),
    connectors=("and", "of", "the", "de", "la"),
    lexicon=("other", "then", "land"),
    squeeze_chunks=False,
)


def bracketed_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, text) with brackets put in around some words: nested, surplus, unclosed."""
    text = F.col("text")
    for old, new in ((" the ", " (the "), (" of ", " of) "), (" de ", " [de "), (" la ", " la】 ")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text_table(spark, folder, "documents").select("doc_id", text.alias("text"))


def document_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, pos, line)"""
    return text_table(spark, folder, "documents").select(
        "doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")
    )


def complication_cells(spark: SparkSession, folder: str) -> DataFrame:
    """(p_partkey, cell): ordinals, sizes, prefixes and punctuation around part fields."""
    key, size = F.col("p_partkey").cast("string"), F.col("p_size").cast("string")
    cell = F.concat(
        F.lit("其他"), key, F.lit(". "), "p_name", size, F.lit(".5x"), size, F.lit("cm、妊娠合并"),
        "p_brand", F.lit("，"), key, F.lit("；"), "p_type", F.lit("？。 妊娠合并"), "p_type",
    )
    return table(spark, folder, "part").select("p_partkey", cell.alias("cell"))


def indication_cells(spark: SparkSession, folder: str) -> DataFrame:
    """(p_partkey, cell): one of four kinds of indication text per part."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("string")
    cell = (
        F.when(key % 4 == 0, F.concat(F.lit("脐带绕颈"), size, F.lit("周+"), "p_name"))
        .when(
            key % 4 == 1,
            F.concat(F.lit("孕"), size, F.lit("+3周("), "p_brand", F.lit(") "), "p_name", F.lit("+"), "p_type"),
        )
        .when(key % 4 == 2, F.concat("p_name", F.lit("查因："), "p_brand", F.lit("，"), "p_type", F.lit(" (?)")))
        .otherwise(
            F.concat(F.lit("孕2产1孕"), size, F.lit("+1周 左枕前，要求手术 "), "p_type", F.lit(" 其他 "), size, F.lit("周"))
        )
    )
    return table(spark, folder, "part").select("p_partkey", cell.alias("cell"))


# -- replies and the cascade --------------------------------------------------


def reply_texts(spark: SparkSession, folder: str) -> DataFrame:
    """(p_partkey, reply): fenced, bare, broken and mistyped rule verdicts."""
    key = F.col("p_partkey")
    good = F.concat(F.lit('{"match_found": true, "target_code": "'), "p_brand", F.lit('", "n": '), "p_size", F.lit("}"))
    reply = (
        F.when(key % 5 == 0, F.concat(F.lit("Sure.\n```json\n"), good, F.lit("\n``` done")))
        .when(key % 5 == 1, F.concat(F.lit("I say "), good, F.lit(" end")))
        .when(key % 5 == 2, F.concat(F.lit('```json {"match_found": tru} ``` '), good))
        .when(key % 5 == 3, F.concat(F.lit('{"match_found": "true", "target_code": "'), "p_brand", F.lit('"}')))
        .otherwise(F.lit("no object here"))
    )
    return table(spark, folder, "part").select("p_partkey", reply.alias("reply"))


def coded_term() -> Column:
    return F.concat("p_name", F.lit(" "), "p_brand")


def uncoded_records(spark: SparkSession, folder: str) -> DataFrame:
    """Wide records with term cells only."""
    lines = record_lines(spark, folder)
    records = wide_records(lines, coded_term(), F.lit(""), False)
    return records.select("record_id", "diagnosis1", "diagnosis2")


def cascade_inputs(spark: SparkSession, folder: str):
    """(cache, rules, resolvers) covering every branch of the cascade.

    The number ``k`` of a term, its smallest part key, decides which stage knows it.
    """
    from dxweave.operators import candidates as K
    from dxweave.operators import cascade as C

    part = table(spark, folder, "part")
    terms = part.groupBy(coded_term().alias("term"), "p_name").agg(F.min("p_partkey").alias("k"))
    k, kind = F.col("k").cast("string"), F.col("k") % 7
    word = [F.split("p_name", " ")[0], F.split("p_name", " ")[1]]
    cache = terms.filter(kind == 0).select("term", F.concat(F.lit("K"), k).alias("code"))
    rules = terms.filter(kind == 1).select("term", F.concat(F.lit("R"), k).alias("code"))
    words = part.select(F.explode(F.split("p_name", " ")).alias("word")).distinct()

    verdicts = terms.filter(kind.isin(2, 3)).select(
        "term",
        F.when(kind == 2, F.concat(F.lit('so ```json {"match_found": true, "target_code": "V'), k, F.lit('"} ``` ok')))
        .otherwise(F.lit('{"match_found": false, "target_code": "no"}'))
        .alias("reply"),
    ).unionByName(
        words.filter(F.col("word").startswith("b")).select(
            F.col("word").alias("term"),
            F.concat(F.lit('{"match_found": true, "target_code": "SV-'), "word", F.lit('"}')).alias("reply"),
        )
    )
    splits = terms.filter(kind.isin(3, 4, 5)).select(
        "term",
        F.when(kind == 3, F.concat(F.lit('{"english_terms": ["'), word[0], F.lit('", "'), word[1], F.lit('"]}')))
        .when(kind == 5, F.concat(F.lit('{"english_terms": "'), word[1], F.lit('"}')))
        .otherwise(F.lit('sorry {"english": 1'))
        .alias("reply"),
    )
    entity = lambda i: F.concat(
        F.lit('{"theCode":"'), F.upper("word"), i.cast("string"), F.lit('","title":"<em>'), F.col("word"),
        F.lit("</em> "), i.cast("string"), F.lit('","chapter":"18"}'),
    )
    response = F.concat(
        F.lit('{"destinationEntities":['),
        F.array_join(F.transform(F.sequence(F.lit(1), F.char_length("word") + 2), entity), ","),
        F.lit("]}"),
    )
    found = words.filter(~F.col("word").startswith("g")).select(
        F.col("word").alias("sub_term"),
        K.candidates_of(F.when(~F.col("word").startswith("r"), response)).alias("candidates"),
        F.when(F.col("word").startswith("r"), F.lit("timeout")).alias("error"),
    )
    selections = (
        terms.filter(F.col("k") % 3 < 2)
        .select("term", "k", F.explode(F.split("p_name", " ")).alias("sub_term"))
        .select(
            "term", "sub_term",
            F.when(F.col("k") % 3 == 0, F.concat(F.lit('{"best_match_code": "S-'), "sub_term", F.lit("-"), k, F.lit('"}')))
            .otherwise(F.lit("no"))
            .alias("reply"),
        )
    )
    # Every reply is there twice, and some are followed by another that comes too late.
    def repeated(replies: DataFrame) -> DataFrame:
        late = replies.withColumn("reply", F.concat(F.lit("~ "), "reply")).filter(F.length("reply") % 2 == 0)
        return replies.unionByName(replies).unionByName(late)

    resolvers = C.Resolvers(
        verdicts=C.recorded(repeated(verdicts)), splits=C.recorded(repeated(splits)),
        candidates=C.recorded(found.unionByName(found)), selections=C.recorded(repeated(selections)),
    )
    return cache, rules, resolvers


def search_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "benchmark")
    return items.select(F.concat(F.lit("B"), F.col("item_id").cast("string")).alias("code"), F.col("text").alias("title"))


# -- dictionaries, context, rules, usage --------------------------------------


def part_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """(line, term, code) with duplicates; names that start with ``red`` are withheld."""
    part = table(spark, folder, "part")
    return part.filter(~F.col("p_name").startswith("red")).select(
        F.col("p_partkey").alias("line"), F.col("p_name").alias("term"), F.col("p_brand").alias("code")
    )


ORDER_RULES = V.ContextRules(
    excluded_tokens=("BUILDING", "AUTOMOBILE"),
    exclusion_keywords=("ION_1", "YF"),
    override_token="1-URGENT",
    override_a=("NATION_2", "A1"),
    override_b=("O", "B1|B2"),
)


def order_risks(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as records with a risk cell and two sibling cells."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    risk = F.concat_ws("|", "o_orderpriority", F.concat(F.lit(" "), "c_mktsegment"), "n_name")
    return joined.select(
        F.col("o_orderkey").alias("record_id"),
        F.when(F.col("o_orderkey") % 11 != 0, risk).alias(V.RISK_COLUMN),
        F.concat("c_mktsegment", F.lit(" "), "n_name", F.lit("Y")).alias(V.INDICATION_COLUMN),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("nan")).otherwise(F.col("o_orderstatus")).alias(V.COMPLICATION_COLUMN),
    )


def order_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation").filter(F.col("n_nationkey") % 5 != 0).select(
        F.col("n_name").alias("term"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("code")
    )
    segments = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("term"), F.concat(F.lit("C"), "c_mktsegment").alias("code")
    ).distinct()
    urgent = table(spark, folder, "orders").filter(F.col("o_orderpriority") < "3").select(
        F.col("o_orderpriority").alias("term"), F.concat(F.lit("P"), "o_orderpriority").alias("code")
    ).distinct()
    return nations.unionByName(segments).unionByName(urgent)


def repair_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Exact rules per part name, contains rules per brand, fill rules per part type."""
    part = table(spark, folder, "part")

    def rules(by: str, base: int, mode: str, keyword: Column, wrong: Column, prefix: str, scope: Column) -> DataFrame:
        k = part.groupBy(by).agg(F.min("p_partkey").alias("k"))
        return k.select(
            (F.col("k") + base).alias("rule_no"),
            F.when(F.col("k") % 4 == 0, "N").otherwise("Y").alias("enabled"),
            F.lit(mode).alias("term_match_mode"),
            keyword.alias("term_keyword"),
            wrong.alias("wrong_code"),
            F.concat(F.lit(prefix), by).alias("correct_code"),
            scope.alias("column_scope"),
        )

    third = F.col("k") % 3
    every = F.lit("ALL")
    return (
        rules("p_name", 0, "exact", F.col("p_name"), F.lit("None"), "X-", F.when(third == 0, "diagnosis1").otherwise(every))
        .unionByName(
            rules("p_brand", 1_000_000, "contains",
                  F.when(third == 0, "anvil").when(third == 1, "blue").otherwise("ri"), F.col("p_brand"), "Y-", every)
        )
        .unionByName(
            rules("p_type", 2_000_000, "contains",
                  F.when(third == 0, "g").when(third == 1, "o").otherwise("w"), F.lit(""), "Z-", every)
        )
    )


def usage_calls(events: DataFrame) -> DataFrame:
    """(label, usage): a call log built from events; every seventh call has no usage."""
    n = F.get_json_object("props", "$.k").cast("int")
    done = F.floor("value").cast("int")
    details = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(', "input_tokens_details": {"cached_tokens": '), (n % 5).cast("string"), F.lit("}")))
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit(', "prompt_tokens_details": {"cached_tokens": '), (n % 4).cast("string"), F.lit("}")))
        .otherwise(F.lit(""))
    )
    usage = F.concat(
        F.lit('{"prompt_tokens": '), n.cast("string"), F.lit(', "completion_tokens": '), done.cast("string"),
        F.lit(', "total_tokens": '), (n + done).cast("string"), details, F.lit("}"),
    )
    return events.select(F.col("event_type").alias("label"), F.when(F.col("event_id") % 7 != 0, usage).alias("usage"))


STATISTICS_PACK = V.CodeGroups(
    groups={"G1": ("Brand#1",), "G2": ("Brand#12", "Brand#2"), "G3": ("Brand#3", "none of all")},
    relabel=("Brand#2", "Brand#2 at zero", "second brand"),
)


def parity_records(spark: SparkSession, folder: str) -> DataFrame:
    parity = (F.col("record_id") % 3).cast("string")
    return noisy_records(spark, folder).withColumn(V.PARITY_COLUMN, F.when(F.col("record_id") % 5 != 0, parity))


# -- files --------------------------------------------------------------------


def csv_cells(spark: SparkSession, folder: str) -> DataFrame:
    """(part, diagnosis1): NA spellings, quotes, separators and line breaks in cells."""
    key = F.col("p_partkey")
    cell = (
        F.when(key % 5 == 0, "NA")
        .when(key % 5 == 1, F.concat("p_name", F.lit("\n"), "p_brand"))
        .when(key % 5 == 2, F.concat(F.lit('"'), "p_type", F.lit('", "'), "p_name"))
        .otherwise(F.col("p_name"))
    )
    return table(spark, folder, "part").select(F.format_string("%012d", key).alias("part"), cell.alias("diagnosis1"))


def two_column_file(lines: DataFrame, path: str) -> None:
    """A file of (term, code) without a header, in the order of ``line``."""
    lines.orderBy("line").select("term", "code").write.option("escape", '"').csv(path)


def legacy_cells(spark: SparkSession, folder: str) -> DataFrame:
    """(p_partkey, the three legacy columns); some cells only say that there is nothing."""
    key = F.col("p_partkey")
    risk = F.when(key % 3 == 0, "其他 /").when(key % 3 == 1, "无并发症").otherwise(F.col("p_name"))
    part = table(spark, folder, "part").select("p_partkey", risk.alias(V.RISK_COLUMN))
    indications = indication_cells(spark, folder).select(
        "p_partkey", F.when(key % 7 == 0, "社会因素").otherwise(F.col("cell")).alias(V.INDICATION_COLUMN)
    )
    complications = complication_cells(spark, folder).withColumnRenamed("cell", V.COMPLICATION_COLUMN)
    # Few bytes that take long to clean: dealt out, as bytes alone would make a few tasks of them.
    return part.join(indications, "p_partkey").join(complications, "p_partkey").repartition(TEXT_TASKS)
