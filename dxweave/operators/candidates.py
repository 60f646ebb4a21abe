"""Candidate codes for a sub-term: recorded search responses, or a token search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dxweave.functions import text as X
from dxweave.session import materialize

RESPONSE_SCHEMA = "destinationEntities array<struct<theCode:string,title:string,chapter:string>>"


def candidates_of(response: Column, keep: int = 5) -> Column:
    """The first candidates of a search response, titles without markup."""
    entities = F.from_json(response, RESPONSE_SCHEMA)["destinationEntities"]
    return F.transform(
        F.slice(entities, 1, keep),
        lambda e: F.struct(
            e["theCode"].alias("code"),
            X.strip_html(F.coalesce(e["title"], F.lit(""))).alias("title"),
            e["chapter"].alias("chapter"),
        ),
    )


def _split(text: Column) -> Column:
    """Words of a text, repeated ones and the empty one among them."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")


def tokens(text: Column) -> Column:
    return F.sort_array(F.array_distinct(F.filter(_split(text), lambda w: w != "")))


#: Postings, and questions of a word, that meet in one join key at most: hot words are spread over blocks of both.
BLOCK = 1 << 10
#: Bytes, about, of a catalogue's postings that are still sent whole to each executor, by way of the driver.
PACKED = 64 << 20
#: Numbers in a row of packed postings, and such rows that a task counts about at most.
NUMBERS = 8
PACKED_ROWS = 1 << 20


def _entities(catalogue: DataFrame, keep: int) -> DataFrame:
    """(code, words, length) of the entities that can enter a list: of those with the same words, the ``keep`` smallest codes.

    Rows of one code are one entity, whose length is that of all its titles.
    """
    titles = catalogue.select("code", tokens(F.col("title")).alias("words")).filter(F.size("words") > 0)
    whole = titles.groupBy("code").agg(F.flatten(F.collect_list("words")).alias("all"))
    # As a string the words sort faster than as an array; none of them holds a blank.
    text = F.array_join(F.sort_array(F.array_distinct("all")), " ")
    same = Window.partitionBy("text", "length").orderBy("code")
    first = whole.select("code", text.alias("text"), F.size("all").alias("length")).withColumn("nth", F.row_number().over(same))
    return first.filter(F.col("nth") <= keep).select("code", F.split("text", " ").alias("words"), "length")


def _in_order(exploded: DataFrame, key: list[str], entry: Column) -> DataFrame:
    """One row per key with its words, the least frequent of the catalogue first."""
    return exploded.groupBy(*key).agg(F.sort_array(F.collect_list(entry)).alias("entries"))


def _blocks(n: str) -> Column:
    return F.ceil(F.greatest(F.col(n), F.lit(1)) / BLOCK).cast("int")


def _probe(questions: DataFrame, postings: DataFrame) -> DataFrame:
    """(key, code, length, score) of entities that hold an asked word and no earlier word of the question.

    ``questions`` is (key, words, word, df, qf[, least]), ``postings`` is (word, code, length, words, place, qf).  Words are in one
    order on both sides, so a pair of a question and an entity comes out once, where their first common word meets, and with
    all words at hand its score is exact.  A word's postings are cut into blocks and its questions into salts.
    """
    asked = questions.withColumn("salt", F.pmod(F.xxhash64("key"), _blocks("qf")).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), _blocks("df") - 1))
    )
    held = postings.withColumn("block", F.pmod(F.xxhash64("code"), _blocks("df")).cast("int")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), _blocks("qf") - 1))
    )
    asked = asked.select("word", "block", "salt", "key", F.col("words").alias("asked"), F.col("least") if "least" in questions.columns else F.lit(0).alias("least"))
    # Both sides grow by blocks and salts beyond what their files tell: broadcast, they could fill the driver.
    held = held.select("word", "block", "salt", "code", "length", "place", F.col("words").alias("held")).hint("merge")
    # Few bytes that fan out: a fixed number of partitions keeps them from being coalesced.
    tasks = int(questions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = asked.repartition(tasks, "word", "block", "salt").join(held, ["word", "block", "salt"]).filter(F.col("place") + F.col("least") <= F.size("held"))
    # A generator computes the common words once a pair; as a condition they would be computed for each use.
    shared = met.select("key", "code", "length", "word", "least", F.explode(F.array(F.array_intersect("asked", "held"))).alias("shared"))
    exact = shared.filter((F.size("shared") >= F.col("least")) & (F.get("shared", F.lit(0)) == F.col("word")))
    return exact.select("key", "code", "length", F.size("shared").alias("score"))


def _packed(asked: DataFrame, entities: DataFrame, titles: int, longest: int, keep: int) -> DataFrame:
    """The lists of all questions (key, sub_term) in one pass over their words, which meet the postings where they are.

    An entity has a counter of as many bits as its score can need, and a number holds several: a row of the postings adds the
    points of a word for ``width`` entities at once.  Entities are numbered by length and code, so that a counter
    and a number rank an entity.  Texts are dealt out once, by key; no step after that moves rows.
    """
    bits = longest.bit_length()
    lanes = 63 // bits
    width = lanes * NUMBERS
    numbered = entities.withColumn("nr", F.row_number().over(Window.orderBy("length", "code")) - 1)
    counters = [f"n{i}" for i in range(NUMBERS)]
    point = F.expr(f"shiftleft(1L, nr % {lanes} * {bits})")
    postings = (
        numbered.select(F.explode("words").alias("word"), F.expr(f"nr div {width}").alias("block"), F.expr(f"nr % {width} div {lanes}").alias("i"), point.alias("point"))
        .groupBy("word", "block")
        .agg(*[F.sum(F.when(F.col("i") == i, F.col("point")).otherwise(0)).alias(n) for i, n in enumerate(counters)])
    )
    tasks = max(
        int(asked.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 + asked.count() * (1 + titles // width) // PACKED_ROWS
    )
    dealt = asked.repartition(tasks, "key")
    words = dealt.select("key", F.explode(F.array_distinct(_split(F.col("sub_term")))).alias("word"))
    counted = words.join(F.broadcast(postings), "word").groupBy("key", "block").agg(*[F.sum(n).alias(n) for n in counters])
    # Negative where there is a point: the higher score first, then the smaller number.
    mask = (1 << bits) - 1
    ranks = [
        F.col("block") * width + F.lit(i * lanes + lane) - F.shiftleft(F.shiftright(n, lane * bits).bitwiseAND(mask), 32)
        for i, n in enumerate(counters)
        for lane in range(lanes)
    ]
    best = counted.select("key", F.explode(F.slice(F.sort_array(F.array(*ranks)), 1, keep)).alias("value")).filter("value < 0")
    listed = best.withColumn("rank", F.row_number().over(Window.partitionBy("key").orderBy("value"))).filter(F.col("rank") <= keep)
    scored = listed.select("key", "rank", (-F.shiftright("value", 32)).alias("score"), F.col("value").bitwiseAND((1 << 32) - 1).alias("nr"))
    coded = scored.join(F.broadcast(numbered.select(F.col("nr").cast("bigint").alias("nr"), "code")), "nr")
    # Texts that repeat themselves are larger than their files: never by way of the driver.
    return coded.join(dealt.hint("merge"), "key").select("sub_term", "code", "score", "rank")


def search(sub_terms: DataFrame, catalogue: DataFrame, keep: int = 5, hot: int = 1000) -> DataFrame:
    """The best entities of a catalogue for each sub-term, ranked from 1.

    ``catalogue`` is (code, title), one row per code.  An entity scores one point per
    distinct word it shares with the sub-term; shorter titles, then smaller codes, win
    ties.  The result is exact for any ``hot``.  Questions without a word of the catalogue have no row.

    Of titles with the same words only the first codes are searched.  If their postings then have at most ``PACKED`` bytes, all
    scores are counted where the questions are; else words are looked up from the rarest on, see ``_looked_up``.
    """
    entities = materialize(_entities(catalogue, keep), "entities")
    # Inside, a sub-term goes by a number: texts may be long and are shuffled often.
    asked = materialize(
        sub_terms.select("sub_term").filter(F.col("sub_term").isNotNull()).distinct().withColumn("key", F.monotonically_increasing_id()), "asked"
    )
    size = F.sum(F.size("words") * F.lit(16 + 10 * NUMBERS).cast("bigint") + F.octet_length(F.array_join("words", "")))
    titles, longest, held = entities.agg(F.count("*"), F.max(F.size("words")), size).first()
    if (held or 0) <= PACKED:
        return _packed(asked, entities, titles, longest or 1, keep)
    return _looked_up(asked, entities, keep, hot)


def _looked_up(asked: DataFrame, entities: DataFrame, keep: int, hot: int) -> DataFrame:
    """The lists of questions for a catalogue too large to be sent.  Words of questions and entities stand in one order, rare
    ones of the catalogue first:

    * The words of a question whose titles are at most ``hot`` together are looked up whole.  The next word is looked up
      in its ``hot`` longest titles only.  Both give entities with their exact scores, and the score of the
      ``keep``-th is a lower bound for the list.
    * With bound b and m words, an entity that could still enter the list has b words of the question, so its first common word is
      among the first m - b + 1 words of the question and of its own n - b + 1.  Only those of the remaining words are
      looked up, and a question whose remaining words are fewer than b is finished.
    """
    asked_words = asked.select("key", F.explode(tokens(F.col("sub_term"))).alias("word"))
    entity_words = entities.select("code", "length", F.explode("words").alias("word"))
    # One row for each word of the catalogue that is asked for: a number, the titles and the questions that hold it.
    known = entity_words.groupBy("word").agg(F.count("*").alias("df")).join(asked_words.groupBy("word").agg(F.count("*").alias("qf")), "word", "left")
    known = materialize(known.na.fill(0, ["qf"]).withColumn("id", F.monotonically_increasing_id()), "words")
    entry = F.struct("df", "id", "qf")
    described = _in_order(entity_words.join(known, "word"), ["code", "length"], entry)
    placed = described.select(
        "code", "length", F.col("entries")["id"].alias("words"), F.posexplode("entries").alias("place", "e")
    )
    # Words that nobody asks for have a place in the order but are not looked up.
    postings = materialize(
        placed.filter("e.qf > 0").select("code", "length", "words", "place", F.col("e.id").alias("word"), "e.df", "e.qf"), "postings"
    )
    running = F.aggregate(
        "entries",
        F.struct(F.lit(0).cast("bigint").alias("titles"), F.lit(0).alias("n")),
        lambda sum, e: F.struct(
            (sum["titles"] + e["df"]).alias("titles"), (sum["n"] + (sum["titles"] + e["df"] <= hot).cast("int")).alias("n")
        ),
    )
    questions = materialize(
        _in_order(asked_words.join(known, "word"), ["key"], entry).select(
            "key", "entries", F.col("entries")["id"].alias("words"), F.size("entries").alias("m"), running["n"].alias("light")
        ),
        "questions",
    )

    def looked_up(df: DataFrame, first: Column, n: Column) -> DataFrame:
        more = [c for c in df.columns if c == "least"]
        return df.select("key", "words", *more, F.inline(F.slice("entries", first + 1, F.greatest(n, F.lit(0))))).withColumnRenamed("id", "word")

    def best(df: DataFrame) -> DataFrame:
        place = Window.partitionBy("key").orderBy(F.desc("score"), F.asc("length"), F.asc("code"))
        return df.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= keep)

    longest = Window.partitionBy("word").orderBy(F.desc("length"), "code")
    some = postings.withColumn("nth", F.row_number().over(longest)).filter(F.col("nth") <= hot).drop("nth")
    light = _probe(looked_up(questions, F.lit(0), F.col("light")), postings)
    bounded = F.least("df", F.lit(hot))
    heavy = looked_up(questions.filter("light < m"), F.col("light"), F.lit(1)).withColumn("df", bounded)
    next_word = _probe(heavy, some.withColumn("df", bounded))
    first = materialize(best(light.unionByName(next_word)).drop("rank"), "candidates")
    bounds = first.groupBy("key").agg(F.count("*").alias("n"), F.min("score").alias("worst"))
    least = F.greatest(F.when(F.col("n") == keep, F.col("worst")).otherwise(0), F.lit(1))
    undecided = questions.join(bounds, "key", "left").withColumn("least", least).filter(F.col("m") - F.col("light") >= F.col("least"))
    second = _probe(looked_up(undecided, F.col("light"), F.col("m") - F.col("least") + 1 - F.col("light")), postings)
    merged = first.unionByName(second).groupBy("key", "code").agg(F.any_value("length").alias("length"), F.max("score").alias("score"))
    return best(merged).join(asked.hint("merge"), "key").select("sub_term", "code", F.col("score").cast("bigint").alias("score"), "rank")


def as_candidates(ranked: DataFrame, catalogue: DataFrame) -> DataFrame:
    """(sub_term, candidates) in the form the cascade takes; at most ``keep`` per row."""
    titled = ranked.join(catalogue.select("code", "title"), "code")
    entry = F.struct("rank", "code", "title", F.lit(None).cast("string").alias("chapter"))
    return titled.groupBy("sub_term").agg(
        F.transform(
            F.sort_array(F.collect_list(entry)),
            lambda e: F.struct(e["code"].alias("code"), e["title"].alias("title"), e["chapter"].alias("chapter")),
        ).alias("candidates")
    )
