import random

from pyspark.sql import functions as F

from dxweave.operators import candidates as K
from dxweave.operators import cascade as C
from dxweave.operators import resume as R
from dxweave.operators import schema as S
from dxweave.operators import usage as U
from dxweave.sources import readers, writers
from dxweave.streaming import incremental, usage_stream


def resolvers(spark):
    def table(rows, schema):
        return C.recorded(spark.createDataFrame(rows, schema))

    response = '{"destinationEntities": [%s]}' % ",".join(
        '{"theCode": "S%d", "title": "<em>T</em>%d", "chapter": "18"}' % (i, i) for i in range(7)
    )
    found = spark.createDataFrame(
        [("s1", response, None), ("s2", response, None), ("s3", '{"destinationEntities": []}', None),
         ("s4", None, "timed out")],
        "sub_term string, response string, error string",
    ).select("sub_term", K.candidates_of(F.col("response")).alias("candidates"), "error")
    return C.Resolvers(
        verdicts=table([("v", '{"match_found": true, "target_code": "VC"}'), ("sv", '{"match_found": true, "target_code": "SV"}'),
                        ("x", '{"match_found": false}')], "term string, reply string"),
        splits=table([("x", '{"english_terms": ["s1", "s2", "sv"]}'), ("y", '```json {"english_terms": "s3"} ```'),
                      ("z", '{"english_terms": ["s4"]}'), ("n", '{"english_terms": []}'), ("q", "broken"),
                      ("w", '{"english_terms": ["s1"]}')],
                     "term string, reply string"),
        candidates=C.recorded(found),
        selections=table([("x", "s1", '{"best_match_code": "S3"}'), ("x", "s2", "no json"), ("w", "s1", '{"other": 1}')],
                         "term string, sub_term string, reply string"),
    )


EXPECTED = {
    "c": ("CACHED", "cache"), "r": ("RULE", "rule"), "v": ("VC", "verdict"),
    "x": ("S3|ERROR: Selection failed|SV", "search"), "y": ("ERROR: No API results", "search"),
    "z": ("ERROR: timed out", "search"), "n": (None, "search"),
    "q": ("ERROR: Splitting/Translation failed: Invalid JSON format.", "error"),
    "w": ("ERROR: Selection failed", "search"),
}


def tables(spark):
    cache = spark.createDataFrame([("c", "CACHED")], "term string, code string")
    rules = spark.createDataFrame([("r", "RULE"), ("c", "NO")], "term string, code string")
    return cache, rules


def test_cascade(spark):
    cache, rules = tables(spark)
    terms = spark.createDataFrame([(t,) for t in list(EXPECTED) * 3], "term string")
    coded = C.code_terms(terms, resolvers(spark), cache, rules)
    assert {r.term: (r.code, r.stage) for r in coded.collect()} == EXPECTED
    assert {r.term for r in C.cache_additions(coded).collect()} == {"r", "v"}


def test_resolver_sees_only_open_terms(spark):
    cache, rules = tables(spark)
    seen = {}

    def spy(name, inner):
        def run(df):
            seen[name] = {r[0] for r in df.collect()}
            return inner(df)
        return run

    base = resolvers(spark)
    watched = C.Resolvers(spy("splits", base.splits), spy("candidates", base.candidates), spy("verdicts", base.verdicts))
    terms = spark.createDataFrame([(t,) for t in EXPECTED], "term string")
    first_choice = {r.term: r.code for r in C.code_terms(terms, watched, cache, rules).collect()}
    assert seen["splits"] == set("xyznqw")
    assert seen["candidates"] == {"s1", "s2", "s3", "s4"}  # a verdict has settled sv
    assert first_choice["x"] == "S0|S0|SV"


def test_code_table_reassembles_cells(spark):
    cache, rules = tables(spark)
    df = spark.createDataFrame(
        [(0, "c|x|n|r", "v"), (1, "||", None), (2, " ", "n"), (3, "q", "")], "record_id long, diagnosis1 string, diagnosis2 string"
    )
    out, _ = C.code_table(df, S.term_columns(df.columns), resolvers(spark), cache, rules)
    got = {r.record_id: (r.diagnosis1_ICD11_Code, r.diagnosis2_ICD11_Code) for r in out.collect()}
    assert got == {
        0: ("CACHED|S3|ERROR: Selection failed|SV|RULE", "VC"),
        1: ("", None), 2: (None, ""), 3: (EXPECTED["q"][0], None),
    }


def test_explode_and_reassemble_is_identity(spark):
    df = spark.createDataFrame([(i, "|".join(f"t{j}" for j in range(i % 13 + 1))) for i in range(60)], "record_id long, diagnosis1 string")
    terms = S.terms_long(df, ["diagnosis1"]).withColumn("code", F.col("term"))
    out = S.attach_cells(df, terms, ["diagnosis1"])
    assert out.filter(F.col("diagnosis1") != F.col("diagnosis1_ICD11_Code")).count() == 0


def test_search_equals_brute_force(spark):
    rng = random.Random(11)
    words = [f"w{i}" for i in range(30)]
    weights = [40 // (i + 1) + 1 for i in range(30)]
    entities = [(f"E{i:03d}", " ".join(rng.choices(words, weights, k=rng.randrange(1, 7)))) for i in range(150)]
    asked = sorted({" ".join(rng.choices(words, weights, k=rng.randrange(1, 5))) for _ in range(120)}) + ["nothing here"]
    expected = set()
    for q in asked:
        scored = []
        for code, title in entities:
            shared = len(set(q.split()) & set(title.split()))
            if shared:
                scored.append((-shared, len(set(title.split())), code))
        expected |= {(q, code, -s, i + 1) for i, (s, _, code) in enumerate(sorted(scored)[:5])}
    catalogue = spark.createDataFrame(entities, "code string, title string")
    queries = spark.createDataFrame([(q,) for q in asked], "sub_term string")
    for hot in (0, 3, 20, 1000):
        got = {tuple(r) for r in K.search(queries, catalogue, hot=hot).collect()}
        assert got == expected, hot
    lists = K.as_candidates(K.search(queries, catalogue), catalogue)
    one = lists.filter(F.col("sub_term") == asked[0]).first()
    assert [c.code for c in one.candidates] == [c for _, c in sorted((r, c) for q, c, _, r in expected if q == asked[0])]


def test_rule_set_version(spark):
    import hashlib

    rows = [(i, f"t{i}", f"c{i}") for i in range(4090, 4100)]
    lines = spark.createDataFrame(rows, "line long, term string, code string")
    numbers = [int(hashlib.md5(f"{i}- Rule: If input implies '{t}', map to '{c}'".encode()).hexdigest()[:15], 16) for i, t, c in rows]
    version = hashlib.md5(f"{len(rows)}:{sum(numbers)}".encode()).hexdigest()[:8]
    for pieces in (1, 7):  # in one piece or in many, on either side of any boundary
        assert C.rule_set_version(lines.repartition(pieces)).first().version == version
    assert C.rule_set_version(lines.filter("line > 4090")).first().version != version
    swapped = lines.withColumn("line", 8189 - F.col("line"))
    assert C.rule_set_version(swapped).first().version != version
    assert C.cache_name("m/x", None) == "diagnosis_term_cache__m_x__no_rules"


def test_resolvers_are_asked_once(spark, tmp_path):
    asked = {name: spark.sparkContext.accumulator(0) for name in ("verdicts", "splits", "candidates", "selections")}

    def counting(name, keys, schema, reply):
        def resolve(terms):
            def run(batches):
                for frame in batches:
                    asked[name].add(len(frame))
                    yield frame[keys].assign(**reply(frame))

            return terms.select(*keys).mapInPandas(run, schema)

        return resolve

    entity = [{"code": "S1", "title": "T", "chapter": "18"}]
    open_resolvers = lambda: C.Resolvers(
        verdicts=counting("verdicts", ["term"], "term string, reply string", lambda f: {"reply": '{"match_found": false}'}),
        splits=counting("splits", ["term"], "term string, reply string",
                        lambda f: {"reply": [f'{{"english_terms": ["{t} a", "{t} b"]}}' for t in f["term"]]}),
        candidates=counting("candidates", ["sub_term"],
                            "sub_term string, candidates array<struct<code: string, title: string, chapter: string>>",
                            lambda f: {"candidates": [entity] * len(f)}),
        selections=counting("selections", ["term", "sub_term"], "term string, sub_term string, reply string",
                            lambda f: {"reply": '{"best_match_code": "S1"}'}),
    )
    rows = [(i, f"t{i % 10}|t{(i + 1) % 10}") for i in range(40)]
    df = spark.createDataFrame(rows, "record_id long, diagnosis1 string")
    expected = {"verdicts": 30, "splits": 10, "candidates": 20, "selections": 20}
    table, coded = C.code_table(df, ["diagnosis1"], open_resolvers())
    assert {r.diagnosis1_ICD11_Code for r in table.collect()} == {"S1|S1|S1|S1"}
    assert coded.count() == 10 and C.cache_additions(coded).count() == 10
    assert {k: v.value for k, v in asked.items()} == expected

    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    where = {k: str(tmp_path / k) for k in ("out", "cache", "checkpoint")}
    incremental.run_incremental_coding(stream, ["diagnosis1"], open_resolvers(), cache_key="k1", **where).awaitTermination()
    assert {r.diagnosis1_ICD11_Code for r in spark.read.parquet(where["out"]).collect()} == {"S1|S1|S1|S1"}
    assert {k: v.value for k, v in asked.items()} == {k: 2 * n for k, n in expected.items()}
    assert incremental.term_cache(where["cache"], "k1").rows(spark, 9).count() == 10
    assert incremental.term_cache(where["cache"], "k2").rows(spark, 9) is None


def test_resume_and_merge(spark):
    df = spark.createDataFrame([(i, "a") for i in range(4)], "record_id long, diagnosis1 string")
    part = lambda rows: spark.createDataFrame(rows, "record_id long, results map<string,string>, line long")
    one = part([(0, {"diagnosis1": "A"}, 0), (1, {"diagnosis1": "B"}, 1), (1, {"diagnosis1": "B2"}, 2)])
    two = part([(0, {"diagnosis1": "A2"}, 0)])
    merged = R.merge_parts([one, two], line="line")
    out = R.merge_results(df, merged, ["diagnosis1"])
    assert {r.record_id: r.diagnosis1_ICD11_Code for r in out.collect()} == {0: "A2", 1: "B2", 2: None, 3: None}
    assert {r.record_id for r in R.unfinished(df, merged).collect()} == {2, 3}


USAGE = [
    ("a", '{"prompt_tokens": 5, "completion_tokens": 2, "total_tokens": 7, "input_tokens_details": {"cached_tokens": 3}}'),
    ("a", '{"prompt_tokens": "x", "prompt_tokens_details": {"cached_tokens": 0}}'),
    ("a", None),
    ("b", '{"prompt_tokens": 1, "input_tokens_details": {}, "prompt_tokens_details": {"cached_tokens": 9}}'),
    ("b", '{"prompt_tokens": 1, "input_tokens_details": {"cached_tokens": null}, "prompt_tokens_details": {"cached_tokens": 9}}'),
]


def test_usage(spark, tmp_path):
    calls = spark.createDataFrame(USAGE, "label string, usage string")
    got = {(r.label, r.is_total): tuple(r)[2:] for r in U.usage_summary(calls).collect()}
    assert got == {
        ("a", 0): (3, 2, 2, 1, 5, 2, 7, 3),
        ("b", 0): (2, 2, 2, 1, 2, 0, 0, 9),
        (None, 1): (5, 4, 4, 2, 7, 2, 7, 12),
    }
    calls.repartition(3).write.json(str(tmp_path / "log"))
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "log"))
    usage_stream.run_usage_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    totals = usage_stream.current_totals(spark.read.parquet(str(tmp_path / "out")))
    assert {r.label: tuple(r)[1:] for r in totals.collect()} == {k[0]: v for k, v in got.items() if not k[1]}


def test_incremental_coding_equals_batch(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, "|".join(rng.choices(sorted(EXPECTED), k=3))) for i in range(30)]
    df = spark.createDataFrame(rows, "record_id long, diagnosis1 string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    cache, rules = tables(spark)
    where = {k: str(tmp_path / k) for k in ("out", "cache", "checkpoint")}
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    known = {"r": "RULE", "c": "NO"}
    incremental.run_incremental_coding(stream, ["diagnosis1"], resolvers(spark), rules=rules, **where).awaitTermination()
    got = {r.record_id: r.diagnosis1_ICD11_Code for r in spark.read.parquet(where["out"]).collect()}
    code = {t: known.get(t, c) for t, (c, _) in EXPECTED.items()}
    assert got == {i: "|".join(code[t] for t in cell.split("|") if code[t]) for i, cell in rows}
    assert incremental.term_cache(where["cache"]).rows(spark).groupBy("term").count().filter("count > 1").count() == 0


def test_sources_and_sinks(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_bytes("﻿uuid,diagnosis1\n1,\"a\nb\"\nNA,无\n3,\n".encode())
    df = readers.read_table(spark, str(path), multi_line=True, ordinal="record_id")
    assert [tuple(r) for r in df.orderBy("record_id").collect()] == [(0, "1", "a\nb"), (1, None, "无"), (2, "3", None)]
    polars = readers.read_table(spark, str(path), dialect="polars", multi_line=True)
    assert {r.uuid for r in polars.collect()} == {"1", "NA", "3"}

    book = tmp_path / "d.csv"
    book.write_text("term,code\na,1\nb\n a ,2\n,3\nc, \n", encoding="utf-8")
    assert {tuple(r) for r in readers.read_dictionary(spark, str(book)).collect()} == {("term", "code"), ("a", "2")}
    lines = readers.read_rule_lines(spark, str(book))
    assert [tuple(r)[1:] for r in lines.orderBy("line").collect()] == [("a", "1"), ("a", "2")]
    assert {tuple(r) for r in readers.exact_rules(lines).collect()} == {("a", "2")}
    assert readers.read_rule_lines(spark, str(tmp_path / "absent.csv")).count() == 0

    log = tmp_path / "log.jsonl"
    log.write_text('{"key": "a", "value": "1"}\noops\n{"key": "b"}\n{"key": "a", "value": "2"}\n'
                   '{"key": "c", "value": "3"}\n{"key": "c", "value": null}\n', encoding="utf-8")
    assert {tuple(r) for r in readers.read_log(spark, str(log), "key").collect()} == {("a", "2")}
    parts = tmp_path / "part.jsonl"
    parts.write_text('{"index": 3, "results": {"diagnosis1": "A"}}\n{"index": 3, "results": {"diagnosis1": null}}\n')
    rows = readers.read_log(spark, str(parts), "index", "map<string,string>").collect()
    assert [(r.key, r.value) for r in rows] == [("3", {"diagnosis1": None})]

    out = str(tmp_path / "out")
    entries = spark.createDataFrame([("a", "1"), ("b", "2")], "key string, value string")
    doubled = entries.union(spark.createDataFrame([("a", "9")], entries.schema)).withColumn("line", F.col("value").cast("int"))
    writers.append_new(doubled, str(tmp_path / "first"), "key", "line")
    assert sorted((r.key, r.value) for r in spark.read.json(str(tmp_path / "first")).collect()) == [("a", "1"), ("b", "2")]
    writers.append_new(entries, out, "key")
    writers.append_new(entries.union(spark.createDataFrame([("c", "3")], entries.schema)), out, "key")
    assert sorted(tuple(r) for r in spark.read.schema(entries.schema).json(out).collect()) == [("a", "1"), ("b", "2"), ("c", "3")]
    writers.write_table(entries, str(tmp_path / "csv"), ["key"])
    again = readers.read_table(spark, str(tmp_path / "csv"))
    assert sorted(tuple(r) for r in again.collect()) == [("a", "1"), ("b", "2")]


def test_row_ordinal_over_several_files(spark, tmp_path):
    for name, n in (("b", 5), ("a", 2000), ("c", 30)):
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{name}{i}\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        df = readers.read_table(spark, [str(tmp_path / f"{n}.csv") for n in "bac"], multi_line=False, ordinal="record_id")
        got = [r.v for r in df.orderBy("record_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"{n}{i}" for n, k in (("a", 2000), ("b", 5), ("c", 30)) for i in range(k)]
