"""Entry points: the flagship query, one query per operator, and the SQL they are checked against."""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from chronolink.functions import dates, lines, markup, titles  # noqa: E402
from chronolink.operators import closure, date_words, filters, headings, links, pages, pairs, sentences, templates, tokens  # noqa: E402
from chronolink.plans.articles import clean_text, extract_pairs, tag_articles  # noqa: E402
from chronolink.plans.corpus import corpus, spread, table  # noqa: E402
from chronolink.session import scratch_path  # noqa: E402
from chronolink.sinks import bounded, versions, writers  # noqa: E402
from chronolink.sources import docs, dump, lists  # noqa: E402
from chronolink.streaming import streams  # noqa: E402

# The operators for training data may be absent; the rest does not depend on them.
try:
    import corpus_pipeline
    from chronolink.llm import queries as llm
except ImportError:
    corpus_pipeline = llm = None

Query = Callable[[SparkSession, str], DataFrame]
URLBASE = "https://wiki.example.org/wiki"
NAMESPACES = {0: "", 10: "Template"}


def documents_of(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def web_pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"), "page_id")


def article_pages(spark: SparkSession, sf: str) -> DataFrame:
    return filters.keep_articles(corpus(spark, sf))


def with_text(pages_df: DataFrame, expression: str) -> DataFrame:
    return pages_df.withColumn("wikitext", F.expr(expression))


def article_step(step: Callable[[Column], Column], expression: str | None = None) -> Query:
    """One cleaning step over the article pages."""

    def run(spark: SparkSession, sf: str) -> DataFrame:
        source = article_pages(spark, sf)
        if expression:
            source = with_text(source, expression)
        return source.select("page_id", step(F.col("wikitext")).alias("text"))

    return run


def html_step(step: Callable[[Column], Column]) -> Query:
    """One cleaning step over the raw web pages."""
    return lambda spark, sf: web_pages(spark, sf).select("page_id", step(F.col("html")).alias("text"))


def prose(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences of tagged articles."""
    return sentences.sentences(tag_articles(clean_text(article_pages(spark, sf))))


def flat_pairs(df: DataFrame) -> DataFrame:
    return df.withColumn("dates", F.array_join("dates", ","))


def pair_table(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pairs(article_pages(spark, sf))


def duplicated(spark: SparkSession, sf: str) -> DataFrame:
    """The page table with a newer revision of every seventh page."""
    base = corpus(spark, sf)
    newer = base.filter("page_id % 7 = 0").withColumn("rev_id", F.col("rev_id") + 1)
    return base.unionByName(newer)


def old_pages(spark: SparkSession, sf: str) -> DataFrame:
    """An earlier state: every fifth page missing, every third in an older revision."""
    return corpus(spark, sf).filter("page_id % 5 <> 0").select(
        "page_id", F.expr("CASE WHEN page_id % 3 = 0 THEN rev_id - 1 ELSE rev_id END").alias("rev_id")
    )


# --- sources and sinks ---------------------------------------------------------------------------
def written_dump(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "dump")
    writers.write_dump(corpus(spark, sf), path, NAMESPACES, f"{URLBASE}/Main", compression="bzip2")
    return path


def scan_dump(spark, sf):
    return dump.read_dump(spark, written_dump(spark, sf))


def scan_namespaces(spark, sf):
    return dump.read_namespaces(spark, written_dump(spark, sf))


def scan_urlbase(spark, sf):
    return dump.read_urlbase(spark, written_dump(spark, sf))


def docs_roundtrip(spark, sf):
    path = scratch_path(spark, "docs")
    writers.write_docs(clean_text(article_pages(spark, sf)), path)
    return docs.read_docs(spark, path)


def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    writers.write_json(clean_text(article_pages(spark, sf)), path, URLBASE)
    return spark.read.schema("id STRING, url STRING, title STRING, text STRING, revid STRING").json(path)


def category_rules(spark, sf):
    path = scratch_path(spark, "rules")
    table(spark, sf, "customer").select(F.expr(oracles.RULE_LINES).alias("value")).write.text(path)
    return lists.read_category_rules(spark, path)


def pair_files(spark, sf):
    path = scratch_path(spark, "pairs")
    writers.write_pairs(pair_table(spark, sf), path, max_records=5000, compression="bzip2", ordered=True)
    return spark.read.option("lineSep", "\r\n").text(path).select(F.col("value").alias("line"))


def bounded_pairs(spark, sf):
    """Pair lines in files of 64 KB; ``fits`` tells whether a line's file has no more than that and one row."""
    path = scratch_path(spark, "bounded")
    lines = writers.format_pairs(pair_table(spark, sf)).withColumnRenamed("line", "value")
    bounded.write_bounded(lines, path, ["page_id", "sid", "link_ord"], 1 << 16, "\r\n")
    found = bounded.read_bounded(spark, path, "\r\n")
    fits = bounded.file_sizes(found, 2).select("part", "file", (F.col("bytes") < (1 << 16) + F.col("longest")).alias("fits"))
    return found.join(fits, ["part", "file"]).select(F.col("value").alias("line"), "fits")


def versioned_articles(spark, sf):
    """An update of stored articles: a reader of the first version goes on reading it."""
    root = scratch_path(spark, "versions")
    articles = clean_text(article_pages(spark, sf)).select("page_id", "rev_id", "title")
    versions.write_version(articles, root)
    before = versions.read_version(spark, root)
    versions.write_version(before.filter("page_id % 3 <> 0").withColumn("rev_id", F.col("rev_id") + 1), root)
    after = versions.read_version(spark, root)
    return before.withColumn("version", F.lit(1)).unionByName(after.withColumn("version", F.lit(2)))


def clustered_range(spark, sf):
    path = scratch_path(spark, "clustered")
    documents = table(spark, sf, "documents").withColumnRenamed("doc_id", "page_id")
    writers.write_clustered(documents, path, group_bytes=1 << 16)
    return filters.filter_id_range(spark.read.parquet(path), 100, 160).select("page_id", "n_chars", F.md5("text").alias("text_md5"))


# --- filters ---------------------------------------------------------------------------------------
def filter_categories(spark, sf):
    rules = spark.createDataFrame(list(oracles.CATEGORY_RULES), "category STRING, mode STRING")
    return filters.filter_categories(article_pages(spark, sf), rules).select("page_id", "title")


def filter_categories_join(spark, sf):
    """Excluding rules on pages in two revisions, of which one may have no text."""
    base = article_pages(spark, sf)
    newer = base.filter("page_id % 7 = 0").withColumns({
        "rev_id": F.col("rev_id") + 1,
        "wikitext": F.expr("CASE WHEN page_id % 2 = 1 THEN replace(wikitext, '[[Category:', '[[Topic:') END"),
    })
    rules = spark.createDataFrame([r for r in oracles.CATEGORY_RULES if r[1] == "exclude"], "category STRING, mode STRING")
    rules = rules.unionByName(spark.createDataFrame([("FURNITURE", "exclude")], rules.schema))
    return filters.filter_categories(base.unionByName(newer), rules).select("page_id", "rev_id")


def category_pairs(spark, sf):
    """The job as it is used: a rule file chooses the pages, and their pairs are extracted."""
    path = scratch_path(spark, "rules")
    lines = [("^" if mode == "exclude" else "") + name for name, mode in oracles.CATEGORY_RULES]
    spark.createDataFrame([(x,) for x in ("# pages on trade", *lines)], "value STRING").write.text(path)
    chosen = filters.filter_categories(article_pages(spark, sf), lists.read_category_rules(spark, path))
    return flat_pairs(extract_pairs(chosen))


def id_range(spark, sf):
    documents = table(spark, sf, "documents").withColumnRenamed("doc_id", "page_id")
    return filters.filter_id_range(documents, 100, 900).select("page_id", "lang", "n_chars")


def min_length(spark, sf):
    documents = table(spark, sf, "documents").select(
        F.col("doc_id").alias("page_id"), F.col("source").alias("title"), "text", "n_chars"
    )
    return filters.min_length(documents, 1000).select("page_id", "n_chars")


# --- cleaning ---------------------------------------------------------------------------------------
def code_bodies(spark, sf):
    source = with_text(article_pages(spark, sf), oracles.CODE_TEXT)
    return clean_text(source).select("page_id", "text")


# --- extraction ------------------------------------------------------------------------------------
def article_lines(spark, sf):
    text = F.split("text", "\n")
    return clean_text(article_pages(spark, sf)).select("page_id", F.posexplode(text).alias("line_no", "line"))


def document_sentences(spark, sf):
    return sentences.sentences(documents_of(spark, sf).select(F.col("doc_id").alias("page_id"), "text"))


def date_mentions(spark, sf):
    found = pairs.mentions(prose(spark, sf)).filter("kind = 'date'")
    return found.select("page_id", "sid", "pos", "value", "surface")


def only_dates(spark, sf):
    """Durations, sets and times of day beside dates: only dates are tagged."""
    source = with_text(article_pages(spark, sf), oracles.TIMES_TEXT)
    found = pairs.mentions(sentences.sentences(tag_articles(clean_text(source)))).filter("kind = 'date'")
    return found.select("page_id", "sid", "pos", "value")


def dates_by_language(spark, sf):
    """Whole texts in four languages, a sentence with dates behind each."""
    texts = documents_of(spark, sf).select("doc_id", "lang", F.expr(oracles.DATED_TEXT).alias("text"))
    return date_words.dates_by_language(texts)


def normalize_dates(spark, sf):
    years = table(spark, sf, "orders").select(
        "o_orderkey", F.year("o_orderdate").cast("string").alias("y")
    )
    value = F.col("value")
    return years.select("o_orderkey", F.expr(oracles.DATE_VALUES).alias("value")).withColumn(
        "date", dates.normalize_date(value)
    )


def stacked_links(spark, sf):
    found = extract_pairs(with_text(article_pages(spark, sf), oracles.STACKED_TEXT))
    return flat_pairs(found).drop("sentence")


def template_calls(spark, sf):
    calls = templates.template_calls(with_text(article_pages(spark, sf), oracles.CALL_TEXT))
    params = F.array_join(
        F.transform(
            F.array_sort(F.map_entries("params")), lambda e: F.concat(e["key"], F.lit("="), e["value"])
        ),
        "|",
    )
    return calls.select("page_id", "template", params.alias("params"))


def title_parts(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.expr(oracles.PART_TITLES).alias("t"))
    return part.select("p_partkey", titles.title_parts(F.col("t")).alias("p")).select("p_partkey", "p.*")


def normalize_titles(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", F.expr(oracles.TITLES).alias("title"))
    return part.withColumn("normalized", titles.normalize_title(F.col("title"), NAMESPACES.values()))


# --- joins and aggregates --------------------------------------------------------------------------
def incremental(spark, sf):
    marked = pages.mark_reusable(corpus(spark, sf).select("page_id", "rev_id"), old_pages(spark, sf))
    status = F.when(F.col("reusable"), "reusable").otherwise("changed")
    return marked.select("page_id", "rev_id", status.alias("status"))


def update_articles(spark, sf):
    stored = old_pages(spark, sf).select(
        "page_id", "rev_id", F.concat(F.lit("Order "), F.col("page_id").cast("string")).alias("title"),
        F.concat(F.lit("stored Order "), F.col("page_id").cast("string")).alias("text"),
    )
    return pages.update_articles(article_pages(spark, sf), stored, clean_text)


def merge_buckets(spark, sf):
    """The update on two tables in buckets of page ids."""
    name = uuid.uuid4().hex
    articles = old_pages(spark, sf).select(
        "page_id", "rev_id", F.concat(F.lit("Order "), F.col("page_id").cast("string")).alias("title"),
        F.concat(F.lit("stored Order "), F.col("page_id").cast("string")).alias("text"),
    )
    stored = pages.write_buckets(articles, f"articles_{name}", scratch_path(spark, "articles"), 8)
    fresh = pages.write_buckets(article_pages(spark, sf), f"pages_{name}", scratch_path(spark, "pages"), 8)
    return pages.merge_buckets(fresh, stored, clean_text)


def counted_extract(spark, sf):
    """The counters of the corpus, as the job that writes its pairs has seen them."""
    seen, counters = pages.counted(corpus(spark, sf), f"corpus-{uuid.uuid4().hex}")
    kept = filters.drop_disambig(filters.keep_articles(seen))
    extract_pairs(kept).write.parquet(scratch_path(spark, "pairs"))
    return spark.createDataFrame([counters.get], "pages LONG, articles LONG, kept LONG")


def dedupe_stored(spark, sf):
    path = scratch_path(spark, "revisions")
    duplicated(spark, sf).write.parquet(path)
    newest = pages.dedupe_stored(spark.read.parquet(path))
    return newest.select("page_id", "rev_id", "title", F.md5("wikitext").alias("text_md5"))


def resolve_redirects(spark, sf):
    edges = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("page_id"),
        F.concat(F.lit("Order "), (F.col("o_orderkey") * 3 % 1000).cast("string")).alias("link"),
    )
    return links.resolve_redirects(edges, links.redirects(corpus(spark, sf)))


def template_join(join) -> Query:
    def run(spark, sf):
        base = corpus(spark, sf)
        calls = templates.template_calls(filters.keep_articles(base))
        return join(calls, templates.templates(base))

    return run


def template_pages(spark, sf):
    table(spark, sf, "part").createOrReplaceTempView("part")
    return spark.sql(oracles.TEMPLATE_PAGES)


def template_edges(spark, sf):
    pages_df = template_pages(spark, sf)
    return closure.template_edges(pages_df, links.redirects(pages_df))


def template_closure(spark, sf):
    return closure.template_closure(template_edges(spark, sf))


def template_reach(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page_id"), F.expr(oracles.PART_CALLS).alias("wikitext"))
    calls = templates.template_calls(lines)
    return closure.template_reach(calls, template_closure(spark, sf), links.redirects(template_pages(spark, sf)))


# --- tokens ------------------------------------------------------------------------------------------
def abbrev_tokens(spark, sf):
    documents = documents_of(spark, sf)
    path = scratch_path(spark, "abbreviations")
    words = documents.select(F.regexp_extract("text", r"(?:^|\s)(\p{L}{2,3})\.", 1).alias("word")).distinct()
    words.filter("word <> ''").select(F.concat("word", F.lit(".")).alias("value")).write.text(path)
    return tokens.token_counts(documents, lists.read_word_list(spark, path))


def clitics(spark, sf):
    documents = documents_of(spark, sf).withColumn("text", F.expr(oracles.CLITIC_TEXT))
    return tokens.clitic_counts(documents)


def phrase_counts(spark, sf):
    path = scratch_path(spark, "phrases")
    w = F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")
    passages = table(spark, sf, "benchmark").select(w.alias("w")).filter(F.size("w") >= 4)
    spans = [(1, 2), (1, 3), (2, 3), (3, 2), (2, 5), (1, 6)]
    phrase = F.explode(F.array(*[F.array_join(F.slice("w", a, n), " ") for a, n in spans]))
    listed = passages.select(phrase.alias("phrase"))
    listed.select(F.concat("phrase", F.lit("\tNN NN")).alias("value")).write.text(path)
    return tokens.phrase_counts(documents_of(spark, sf), lists.read_phrases(spark, path))


# --- streams -------------------------------------------------------------------------------------------
def page_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The page table as a stream over the orders file."""
    source = spark.readStream.schema(table(spark, sf, "orders").schema)
    orders = source.option("pathGlobFilter", "orders.parquet").parquet(sf)
    # one small file: give the text work a task per core
    return corpus(spark, sf, orders.repartition(spark.sparkContext.defaultParallelism, "o_orderkey"))


def stream_pairs(spark, sf):
    source = filters.keep_articles(page_stream(spark, sf))
    return flat_pairs(streams.run_to_end(spark, lambda p, c: streams.stream_pairs(source, p, c), "stream-pairs"))


def stream_dump_pairs(spark, sf):
    source = filters.keep_articles(dump.stream_dump(spark, written_dump(spark, sf), max_files_per_trigger=4))
    return flat_pairs(streams.run_to_end(spark, lambda p, c: streams.stream_pairs(source, p, c), "stream-dump"))


def stream_dedupe(spark, sf):
    base = page_stream(spark, sf).select("page_id", "rev_id", "title")
    newer = base.filter("page_id % 7 = 0").withColumn("rev_id", F.col("rev_id") + 1)
    source = base.unionByName(newer).unionByName(base.filter("page_id % 2 = 0"))
    seen = source.withColumn("seen", F.current_timestamp())  # when it arrived; bounds the state
    found = streams.run_to_end(spark, lambda p, c: streams.stream_dedupe(seen, p, c, "seen"), "stream-dedupe")
    return found.drop("seen")


def stream_incremental(spark, sf):
    source, stored = filters.keep_articles(page_stream(spark, sf)), old_pages(spark, sf)
    found = streams.run_to_end(
        spark, lambda p, c: streams.stream_incremental(source, stored, p, c), "stream-incremental"
    )
    return flat_pairs(found.drop("run", "batch_id"))


def stream_seeded(spark, sf):
    source, stored = filters.keep_articles(page_stream(spark, sf)), old_pages(spark, sf)
    return flat_pairs(
        streams.run_to_end(spark, lambda p, c: streams.stream_seeded(source, stored, p, c), "stream-seeded")
    )


# --- scalar mapping --------------------------------------------------------------------------------------
def scalar_strings(spark, sf):
    name, brand = F.col("p_name"), F.col("p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.lower(brand).alias("lc"),
        F.upper(name).alias("uc"),
        titles.upper_first(name).alias("ucfirst"),
        titles.lower_first(brand).alias("lcfirst"),
        markup.url_quote(F.concat(name, F.lit("/"), brand, F.lit("*~"))).alias("urlencode"),
        F.col("p_size").cast("string").cast("int").alias("int_value"),
        F.length(name).alias("len"),
        F.substring(name, 2, 3).alias("sub"),
        F.substring(name, F.lit(3), F.greatest(F.length(name) - 3, F.lit(0))).alias("sub_negative"),
        F.substring(name, 3, 4).alias("sublength"),
        F.substring(name, 2, 1).alias("pos"),
        F.locate("e", name).alias("find"),
        F.replace(name, F.lit("e"), F.lit("E")).alias("replaced"),
        F.regexp_replace(name, "[aeiou]", "_").alias("replaced_regex"),
        F.repeat(brand, 2).alias("rep"),
    )


def scalar_logic(spark, sf):
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    debt = F.when(F.col("c_acctbal") < 0, " debt ").otherwise(" ")
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.when(F.trim(debt) != "", F.trim(debt)).otherwise("ok").alias("if_value"),
        F.when(F.trim(segment) == "BUILDING", "yes").otherwise("no").alias("ifeq"),
        F.when(segment.isin("BUILDING", "FURNITURE"), "house")
        .when(segment == "MACHINERY", "work")
        .otherwise("other")
        .alias("switch"),
        F.coalesce(
            F.nullif(F.when(key % 3 == 0, F.col("c_name")).otherwise(""), F.lit("")),
            F.nullif(F.when(key % 3 == 1, segment).otherwise(""), F.lit("")),
            F.lit("none"),
        ).alias("if_empty"),
    )


def entry(spark: SparkSession) -> DataFrame:
    """Which linked titles go with which dates, sentence by sentence."""
    return flat_pairs(pair_table(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Query]:
    more = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return more | {
        # sources and sinks
        "scan_dump": scan_dump,
        "scan_namespaces": scan_namespaces,
        "scan_urlbase": scan_urlbase,
        "docs_roundtrip": docs_roundtrip,
        "json_roundtrip": json_roundtrip,
        "category_rules": category_rules,
        "format_pairs": lambda s, d: writers.format_pairs(pair_table(s, d)),
        "pair_files": pair_files,
        "bounded_pairs": bounded_pairs,
        "versioned_articles": versioned_articles,
        "clustered_range": clustered_range,
        # filters
        "keep_articles": lambda s, d: article_pages(s, d).select("page_id", "rev_id", "title"),
        "drop_disambig": lambda s, d: filters.drop_disambig(article_pages(s, d)).select("page_id", "title"),
        "page_categories": lambda s, d: filters.page_categories(article_pages(s, d)),
        "filter_categories": filter_categories,
        "filter_categories_join": filter_categories_join,
        "category_pairs": category_pairs,
        "id_range": id_range,
        "min_length": min_length,
        # cleaning
        "clean_text": lambda s, d: clean_text(article_pages(s, d)),
        "drop_templates": article_step(markup.drop_templates),
        "drop_tables": article_step(markup.drop_tables),
        "keep_tables": article_step(markup.keep_table_text, oracles.TABLE_TEXT),
        "strip_emphasis": article_step(markup.strip_emphasis),
        "strip_links": article_step(markup.strip_links, oracles.LINK_TEXT),
        "link_labels": article_step(lambda c: markup.strip_links(c, keep_links=False), oracles.LINK_TEXT),
        "encoded_links": article_step(lambda c: markup.strip_links(c, encode=True), oracles.ENCODED_TEXT),
        "drop_external_links": article_step(markup.drop_external_links),
        "drop_switches": article_step(markup.drop_switches),
        "unescape_entities": html_step(markup.unescape_entities),
        "drop_comments": html_step(markup.drop_comments),
        "drop_selfclosing": article_step(markup.drop_selfclosing),
        "strip_tags": html_step(markup.strip_tags),
        "drop_elements": html_step(markup.drop_elements),
        "placeholders": article_step(markup.number_placeholders, oracles.PLACEHOLDER_TEXT),
        "normalize_text": article_step(markup.normalize_text, oracles.NORMALIZE_TEXT),
        "code_bodies": code_bodies,
        "nowiki_spans": article_step(
            lambda c: markup.drop_templates(c, protect_nowiki=True), oracles.NOWIKI_TEXT
        ),
        "article_lines": article_lines,
        "headings": lambda s, d: headings.headings(with_text(article_pages(s, d), oracles.HEADING_TEXT)),
        "text_without_lists": lambda s, d: clean_text(
            with_text(article_pages(s, d), oracles.LIST_TEXT), keep_lists=False
        ),
        "list_items": lambda s, d: headings.list_items(with_text(article_pages(s, d), oracles.LIST_TEXT)),
        # extraction
        "links": lambda s, d: links.links(clean_text(article_pages(s, d))),
        "undated_links": lambda s, d: links.undated_links(clean_text(with_text(article_pages(s, d), oracles.STACKED_TEXT))),
        "page_links": lambda s, d: links.html_links(web_pages(s, d)),
        "sections": lambda s, d: sentences.sections(clean_text(article_pages(s, d), keep_sections=True)),
        "sentences": lambda s, d: sentences.sentences(clean_text(article_pages(s, d))),
        "document_sentences": document_sentences,
        "date_mentions": date_mentions,
        "only_dates": only_dates,
        "whole_sentences": lambda s, d: sentences.sentences(clean_text(article_pages(s, d)), whole_doc=True),
        "intervals": lambda s, d: date_mentions(s, d).filter(F.col("value").startswith("[")),
        "normalize_dates": normalize_dates,
        "dates_by_language": dates_by_language,
        "pair_dates": lambda s, d: flat_pairs(pair_table(s, d)),
        "pair_mentions": lambda s, d: flat_pairs(pairs.pair_mentions(pairs.mentions(prose(s, d)))),
        "stacked_links": stacked_links,
        "templates": lambda s, d: templates.templates(corpus(s, d)),
        "redirects": lambda s, d: links.redirects(corpus(s, d)),
        "template_calls": template_calls,
        "title_parts": title_parts,
        "normalize_titles": normalize_titles,
        # joins and aggregates
        "incremental": incremental,
        "update_articles": update_articles,
        "dedupe_pages": lambda s, d: pages.dedupe_pages(duplicated(s, d)).select("page_id", "rev_id", "title"),
        "merge_buckets": merge_buckets,
        "dedupe_stored": dedupe_stored,
        "counted_extract": counted_extract,
        "corpus_stats": lambda s, d: pages.corpus_stats(corpus(s, d)),
        "resolve_redirects": resolve_redirects,
        "template_usage": template_join(templates.template_usage),
        "missing_templates": template_join(templates.missing_templates),
        "template_edges": template_edges,
        "template_closure": template_closure,
        "template_reach": template_reach,
        "date_kind_counts": lambda s, d: pairs.date_kind_counts(pair_table(s, d)),
        "link_timeline": lambda s, d: pairs.link_timeline(pair_table(s, d)),
        # tokens
        "token_counts": lambda s, d: tokens.token_counts(documents_of(s, d)),
        "abbrev_tokens": abbrev_tokens,
        "clitics": clitics,
        "phrase_counts": phrase_counts,
        # streams
        "stream_pairs": stream_pairs,
        "stream_dump_pairs": stream_dump_pairs,
        "stream_dedupe": stream_dedupe,
        "stream_incremental": stream_incremental,
        "stream_seeded": stream_seeded,
        # scalar mapping
        "scalar_strings": scalar_strings,
        "scalar_logic": scalar_logic,
    }




def oracle_sql() -> dict[str, str]:
    more = llm.oracle_sql() if llm else {}
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return more | oracles.oracle_sql()
