"""Benchmark passages in training documents, by a positional inverted index.

The index is a written table of postings (term, document line, position), in the order of the documents, so building it shuffles nothing; lists of words that no test asks
for are left out. A phrase is found by intersecting the lists of its words, each moved back by the word's offset in
the phrase: what is left are the phrase's starts. The rarest word's list comes first, the next rarest ones thin it out, and the common words' lists are asked only for
the few documents that are left by then. With ``slop`` a word may stand that far from its place, which gives proximity matches.

Only SQL functions run here. Joins with terms or phrases are broadcast by Spark where the written table is small, and shuffled with adaptive skew
splitting where it is not; joins between lists are by line and place, which spreads a word or a document with most of the postings.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch

WINDOW = 10
ALONE = 3  # so many of a phrase's rarest lists are intersected one by one, all others together
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = "".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))


def words_of(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased; none for a null one."""
    text = F.coalesce(text, F.lit(""))
    narrow = F.octet_length(text) == F.char_length(text)
    lower = F.when(narrow, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))
    inner = F.btrim(lower, F.lit(_BETWEEN))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SEPARATORS))


def passages(scratch: Scratch, items: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(phrase, words), every different run of ``size`` words of the items once, and (phrase, item) for the items that hold it.

    An item of fewer words is one phrase, one without words none. An item with a null id gives phrases, but no row of the second table."""
    words = items.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("words")).where("size(words) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - F.lit(size - 1)))
    runs = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, size))).alias("words"))
    runs = scratch.keep(runs.distinct())
    phrases = scratch.keep(runs.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()))
    return phrases, scratch.keep(runs.where("item IS NOT NULL").join(phrases, "words").select("phrase", "item"))


def terms_of(scratch: Scratch, phrases: DataFrame) -> DataFrame:
    """(word, term): a number from 1 for every different word of the phrases, and 0 for the row that stands for the document itself."""
    found = phrases.select(F.explode("words").alias("word")).distinct()
    found = found.select("word", (F.monotonically_increasing_id() + 1).alias("term"))
    return scratch.keep(found.unionByName(found.sparkSession.range(1).select(F.lit("").alias("word"), F.col("id").alias("term"))))


def index(scratch: Scratch, documents: DataFrame, terms: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(line, id, n_words, term, pos): the postings of the terms, positions from 1, and for every document one of term 0 at position 0.

    A line is one row of ``documents``. All is written in one pass over the texts."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("line"), F.col(id_col).alias("id"), words_of(F.col(text_col)).alias("words")
    )
    places = rows.select(
        "line", "id", F.size("words").alias("n_words"), F.posexplode(F.concat(F.array(F.lit("")), "words")).alias("pos", "word")
    )
    return scratch.keep(places.join(terms, "word").select("line", "id", "n_words", "term", "pos"))


def by_rarity(scratch: Scratch, postings: DataFrame, phrases: DataFrame, terms: DataFrame) -> DataFrame:
    """(phrase, length, rank, offset, term): the words of every phrase, the one with the shortest list first. Phrases with a word that no document has are left out."""
    lengths = postings.where("term > 0").groupBy("term").agg(F.count("*").alias("uses"))
    words = phrases.select("phrase", F.size("words").alias("length"), F.posexplode("words").alias("offset", "word"))
    known = words.join(terms, "word").join(lengths, "term")
    of_phrase = Window.partitionBy("phrase")  # as many rows as the phrase has words
    known = known.withColumn("found", F.count("*").over(of_phrase)).where("found = length")
    rank = F.row_number().over(of_phrase.orderBy("uses", "offset"))
    return scratch.keep(known.select("phrase", "length", rank.alias("rank"), "offset", "term"))


def _near(wanted: DataFrame, postings: DataFrame, slop: int) -> DataFrame:
    """The rows of ``wanted`` (line, term, place and more) whose term stands within ``slop`` of the place in that line.

    Places fall into cells of 2 * slop + 1, so that a row meets at most two of them."""
    width = 2 * slop + 1
    cell = lambda place: F.floor(place / F.lit(width)).cast("long")
    lists = postings.select(F.col("line").alias("_line"), F.col("term").alias("_term"), cell(F.col("pos")).alias("_cell"), "pos")
    if not slop:
        same = (F.col("line") == F.col("_line")) & (F.col("place") == F.col("_cell")) & (F.col("term") == F.col("_term"))
        return wanted.join(lists, same, "left_semi")
    cells = F.array_distinct(F.array(cell(F.col("place") - slop), cell(F.col("place") + slop)))
    same = (F.col("line") == F.col("_line")) & (F.col("cell") == F.col("_cell")) & (F.col("term") == F.col("_term"))
    near = F.abs(F.col("pos") - F.col("place")) <= slop
    return wanted.withColumn("cell", F.explode(cells)).join(lists, same & near, "left_semi").drop("cell").distinct()


def matches(scratch: Scratch, postings: DataFrame, ranked: DataFrame, slop: int = 0) -> DataFrame:
    """(phrase, length, line, start): where phrases stand.

    ``start`` is the place of the first word as the rarest one implies it, the first of these among equally rare ones. Without slop that is an
    occurrence of the phrase; with it, every other word occurs within ``slop`` of its own place."""
    lists = postings.where("term > 0").select("line", "term", "pos")

    def listed(rank: Column) -> DataFrame:
        """The lists of the words that are asked for at these ranks."""
        return lists.join(ranked.where(rank).select("term").distinct(), "term", "left_semi")

    rarest = ranked.where("rank = 1").drop("rank")
    found = scratch.keep(
        lists.join(rarest, "term").select("phrase", "length", "line", (F.col("pos") - F.col("offset")).cast("long").alias("start"))
    )
    for rank in range(2, ALONE + 1):
        word = ranked.where(F.col("rank") == rank).select("phrase", "offset", "term")
        wanted = found.where(F.col("length") >= rank).join(word, "phrase").withColumn("place", F.col("start") + F.col("offset"))
        passed = _near(wanted, listed(F.col("rank") == rank), slop).select("phrase", "length", "line", "start")
        thinner = scratch.keep(passed.unionByName(found.where(F.col("length") < rank)))
        scratch.drop(found)
        found = thinner
    left = scratch.keep(found.where(F.col("length") > ALONE).select("line").distinct())
    rest = ranked.where(F.col("rank") > ALONE).select("phrase", "offset", "term")
    wanted = found.join(rest, "phrase").withColumn("place", F.col("start") + F.col("offset"))
    present = _near(wanted, listed(F.col("rank") > ALONE).join(left, "line", "left_semi"), slop)
    whole = present.groupBy("phrase", "length", "line", "start").agg(F.count("*").alias("n")).where(F.col("n") == F.col("length") - ALONE)
    out = scratch.keep(whole.drop("n").unionByName(found.where(F.col("length") <= ALONE)))
    scratch.drop(found)
    scratch.drop(left)
    return out


def find_phrases(
    documents: DataFrame, phrases: DataFrame, slop: int = 0, id_col: str = "doc_id", text_col: str = "text",
    phrase_id_col: str = "phrase_id", phrase_col: str = "phrase",
) -> DataFrame:
    """(document's id, phrase's id, start): where whole phrases of any length stand, exactly or within ``slop`` of their places; see :func:`matches`.

    Documents with repeated ids are searched each; phrases without words are not found. Phrases and documents may be null."""
    scratch = Scratch(documents.sparkSession, "phrases")
    worded = phrases.select(F.col(phrase_id_col).alias("item"), words_of(F.col(phrase_col)).alias("words")).where("size(words) > 0")
    worded = scratch.keep(worded)
    different = scratch.keep(worded.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()))
    terms = terms_of(scratch, different)
    postings = index(scratch, documents, terms, id_col, text_col)
    found = matches(scratch, postings, by_rarity(scratch, postings, different, terms), slop)
    named = worded.join(different, "words").select("phrase", "item")
    ids = postings.where("term = 0").select("line", "id")
    out = found.join(named, "phrase").join(ids, "line").select(F.col("id").alias(id_col), F.col("item").alias(phrase_id_col), "start")
    out = scratch.keep(out)
    scratch.only(out)
    return out


def contaminated_documents(
    documents: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_words, n_hit (words inside an occurrence of a window), n_items, items_sha256, contaminated.

    A window is a run of ``size`` words of an item, or all of a shorter one. Null and empty texts have no words. Items that share an id count once; an item with a
    null id marks words, but is not counted or listed. Rows that repeat an id, null ids among them, are documents of their own. No items: nothing is hit.
    Other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "contamination")
    phrases, holders = passages(scratch, items, item_id_col, item_text_col, size)
    terms = terms_of(scratch, phrases)
    postings = index(scratch, documents, terms, id_col, text_col)
    found = matches(scratch, postings, by_rarity(scratch, postings, phrases, terms))
    # Occurrences of a line in order of their starts: each adds the words that no earlier one has reached.
    earlier = Window.partitionBy("line").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.select("line", "start", (F.col("start") + F.col("length")).alias("end")).distinct()
    reached = F.coalesce(F.max("end").over(earlier), F.lit(0))
    added = F.greatest(F.lit(0), F.col("end") - F.greatest("start", reached))
    hits = ends.select("line", added.alias("added")).groupBy("line").agg(F.sum("added").alias("n_hit"))
    held = found.select("line", "phrase").distinct().join(holders, "phrase").groupBy("line").agg(F.array_sort(F.collect_set("item")).alias("items"))
    lines = postings.where("term = 0").select("line", "id", "n_words").join(hits, "line", "left").join(held, "line", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    out = scratch.keep(
        lines.select(
            F.col("id").alias(id_col), F.col("n_words").cast("long").alias("n_words"), n_hit.alias("n_hit"),
            F.size(listed).cast("long").alias("n_items"), F.sha2(F.array_join(listed, ",").cast("binary"), 256).alias("items_sha256"),
            (n_hit > 0).alias("contaminated"),
        )
    )
    scratch.only(out)  # the index goes
    return out
