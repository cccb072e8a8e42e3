"""Token and phrase counts.

Words are what lies between blanks, and a word splits the same way wherever it stands. So words are
counted first and only the distinct ones are split: the per-word work and the rows that move grow
with the vocabulary, not with the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chronolink.functions.compose import let
from chronolink.functions.titles import upper_first
from chronolink.session import stored

# --- fixed values -------------------------------------------------------------------------------
# Characters cut off in front of and behind a word.
LEADING = "[¿¡{(\\`\"‚„†‡‹‘’“”•–—›'"
TRAILING = "]}'`\"),;:!?%‚„…†‡‰‹‘’“”•–—›"

# Clitics by language: cut off in front of and behind a word.
PREFIX_CLITICS = {
    "fr": ("[dcjlmnstDCJLNMST]'", "[Qq]u'", "[Jj]usqu'", "[Ll]orsqu'"),
    "it": (
        "[dD][ae]ll'", "[nN]ell'", "[Aa]ll'", "[lLDd]'", "[Ss]ull'", "[Qq]uest'", "[Uu]n'",
        "[Ss]enz'", "[Tt]utt'",
    ),
}
SUFFIX_CLITICS = {
    "en": ("'(?:s|re|ve|d|m|em|ll)", "n't"),
    "fr": (
        "-t-elles?", "-t-ils?", "-t-on", "-ce", "-elles?", "-ils?", "-je", "-la", "-les?", "-leur",
        "-lui", "-mmes?", "-m'", "-moi", "-nous", "-on", "-toi", "-tu", "-t'", "-vous", "-en", "-y",
        "-ci", "-l",
    ),
    "gl": ("-la", "-las", "-lo", "-los", "-nos"),
}
# Languages in which a number keeps its period (an ordinal).
ORDINAL_PERIOD = ("de",)
# -------------------------------------------------------------------------------------------------


def _char_class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "[]\\^-" else c for c in chars) + "]"


_LEAD = _char_class(LEADING)
_TRAIL = _char_class(TRAILING)


def split_words(text: Column) -> Column:
    """Blank-separated words of a text; markup tags stay whole, missing blanks are put in."""
    tag = r"<[^<>]*>"

    def spaced(piece: Column) -> Column:
        x = F.regexp_replace(piece, r"\.\.\.", " ... ")
        x = F.regexp_replace(x, r"([;!?])([^ ])", "$1 $2")
        return F.regexp_replace(x, r"([.,:])([^ 0-9.])", "$1 $2")

    def words(piece: Column) -> Column:
        # the segment ends in a blank of its own, so a stop at its end needs none
        padded = spaced(F.concat(F.lit(" "), F.regexp_replace(piece, r"[\n\t]", " "), F.lit(" ")))
        return F.filter(F.split(padded, r"\s+", -1), lambda w: w != "")

    def with_tags(t: Column) -> Column:
        tags = F.regexp_extract_all(t, F.lit(tag), F.lit(0))
        pieces = F.transform(
            F.split(t, tag, -1),
            lambda piece, i: F.concat(
                words(piece),
                F.when(i < F.size(tags), F.array(F.regexp_replace(F.get(tags, i), r"[\n\t]", " ")))
                .otherwise(F.array().cast("array<string>")),
            ),
        )
        return F.when(t.contains("<"), F.flatten(pieces)).otherwise(words(t))

    return let(text, with_tags)


def explode_array(array: str) -> Column:
    """Explode a computed array column.

    For a plain column the optimizer infers a size filter and pushes it, with the whole computation of
    the array, to every input row. An expression around the column keeps it from doing so.
    """
    return F.explode(F.filter(array, lambda x: x.isNotNull()))


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def peel_word(word: Column) -> Column:
    """``struct<lead, core, trail>``: punctuation cut off on both sides, one character always stays.

    A period goes with the punctuation when punctuation stands in front of it.
    """

    def peel(w: Column) -> Column:
        lead = F.regexp_extract(w, rf"(?s)^({_LEAD}*)(.+)$", 1)
        rest = F.substring(w, F.length(lead) + 1, F.length(w))

        def cut(r: Column) -> Column:
            run = F.length(F.regexp_extract(F.reverse(r), rf"^(?:\.?+{_TRAIL})*+", 0))
            kept = F.greatest(F.length(r) - run, F.lit(1))
            return F.struct(
                lead.alias("lead"),
                F.substring(r, F.lit(1), kept).alias("core"),
                F.substring(r, kept + 1, F.length(r)).alias("trail"),
            )

        return let(rest, cut)

    tag = F.struct(F.lit("").alias("lead"), word.alias("core"), F.lit("").alias("trail"))
    return F.when(word.rlike(r"(?s)^<.*>$"), tag).otherwise(let(word, peel))


def ends_sentence(core: Column, lang: Column) -> Column:
    """Does the final period of a word stand for itself, lists of abbreviations aside?"""
    ordinal = lang.isin(*ORDINAL_PERIOD) & core.rlike(r"^[0-9]+\.$")
    return (
        core.rlike(r"(?s)^.+\.$")
        & (core != "...")
        & ~core.rlike(r"^(?:[A-Za-z-]\.)++$")
        & ~ordinal
    )


def split_clitics(word: Column, lang: Column) -> Column:
    """Double dashes and the clitics of the language as tokens of their own."""

    def either(forms) -> str:
        # the engine takes the first form that fits, so longer ones come first
        return "|".join(sorted(forms, key=len, reverse=True))

    def pick(table: dict, pattern) -> Column:
        # a pattern that never matches for languages without clitics
        chosen = F.lit("(?!)")
        for name, forms in table.items():
            chosen = F.when(lang == name, F.lit(pattern(either(forms)))).otherwise(chosen)
        return chosen

    def parts(w: Column) -> Column:
        front = F.regexp_extract(w, r"(?s)^((?:--(?=.))*+)", 1)
        after = F.substring(w, F.length(front) + 1, F.length(w))
        prefix = pick(PREFIX_CLITICS, lambda p: f"(?:{p})(?=.)")
        heads = F.regexp_extract_all(after, F.concat(F.lit(r"(?s)\G"), prefix), F.lit(0))

        def tail(a: Column) -> Column:
            dashes = F.regexp_extract(F.reverse(a), r"(?s)^((?:--(?=.))*+)", 1)
            stem = F.substring(a, F.lit(1), F.length(a) - F.length(dashes))
            suffix = pick(SUFFIX_CLITICS, lambda p: p)
            whole = F.concat(F.lit("(?s)^.+?((?:"), suffix, F.lit(")*+)$"))
            run = F.coalesce(F.get(F.regexp_extract_all(stem, whole, F.lit(1)), 0), F.lit(""))
            return F.concat(
                F.array(F.substring(stem, F.lit(1), F.length(stem) - F.length(run))),
                F.regexp_extract_all(run, suffix, F.lit(0)),
                F.regexp_extract_all(dashes, F.lit("--"), F.lit(0)),
            )

        return let(
            heads,
            lambda h: F.concat(
                F.regexp_extract_all(front, F.lit("--"), F.lit(0)),
                h,
                let(F.substring(after, F.length(F.array_join(h, "")) + 1, F.length(after)), tail),
            ),
        )

    plain = word.rlike(r"(?s)^<.*>$") | ~word.rlike(r"['-]")
    return F.when(plain, F.array(word)).otherwise(let(word, parts))


def word_counts(documents: DataFrame) -> DataFrame:
    """Occurrences of each blank-separated word per language; combined map-side."""
    return (
        documents.select("lang", F.explode(split_words(F.col("text"))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def word_tokens(words: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """Adds ``tokens`` to distinct words. ``listed`` (column word) holds abbreviations and other words
    that are not split further; the engine broadcasts it while it is small."""
    peeled = words.withColumn("p", peel_word(F.col("word"))).select(
        *words.columns, F.col("p.lead").alias("lead"), F.col("p.core").alias("core"),
        F.col("p.trail").alias("trail"),
    )
    stops = ends_sentence(F.col("core"), F.col("lang"))
    peeled = peeled.withColumn("stop", F.when(stops, F.lit(".")).otherwise(F.lit("")))
    stem = F.when(F.col("stop") == ".", F.regexp_replace("core", r"\.$", "")).otherwise(F.col("core"))
    peeled = peeled.withColumn("stem", stem)
    whole, bare = F.lit(False), F.lit(False)
    if listed is not None:
        names = listed.select(F.col("word").alias("entry")).distinct()
        peeled = (
            peeled.join(names.withColumn("whole", F.lit(True)), F.col("core") == F.col("entry"), "left")
            .drop("entry")
            .join(names.withColumn("bare", F.lit(True)), F.col("stem") == F.col("entry"), "left")
            .drop("entry")
        )
        whole = F.coalesce("whole", F.lit(False))
        bare = F.coalesce("bare", F.lit(False))
    initials = F.col("core").rlike(r"^(?:[A-Za-z-]\.)++$")
    body = (
        F.when(whole | initials, F.array(F.col("core")))
        .when(bare & (F.col("stop") == "."), F.array(F.col("stem"), F.lit(".")))
        .otherwise(
            F.concat(
                split_clitics(F.col("stem"), F.col("lang")),
                F.when(F.col("stop") == ".", F.array(F.lit("."))).otherwise(
                    F.array().cast("array<string>")
                ),
            )
        )
    )
    tokens = F.concat(_characters(F.col("lead")), body, _characters(F.col("trail")))
    return peeled.select(*words.columns, tokens.alias("tokens"))


def token_counts(documents: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """How often each token occurs per language."""
    return (
        word_tokens(word_counts(documents), listed)
        .select("lang", "n", explode_array("tokens").alias("token"))
        .groupBy("lang", "token")
        .agg(F.sum("n").alias("n"))
    )


def clitic_counts(documents: DataFrame) -> DataFrame:
    """Words that carry clitics, how they split, and how often they occur."""
    words = word_counts(documents).filter(F.col("word").rlike(r"['-]"))
    peeled = words.withColumn("core", peel_word(F.col("word"))["core"])
    stem = F.when(
        ends_sentence(F.col("core"), F.col("lang")), F.regexp_replace("core", r"\.$", "")
    ).otherwise(F.col("core"))
    parts = split_clitics(stem, F.col("lang"))
    # a condition on n as well keeps the optimizer from testing every occurrence of a word
    return (
        peeled.select("lang", "n", parts.alias("parts"))
        .filter(F.when(F.col("n") > 0, F.size("parts") > 1))
        .groupBy("lang", F.array_join("parts", " ").alias("parts"))
        .agg(F.sum("n").alias("n"))
    )


def phrase_trie(phrases: DataFrame) -> DataFrame:
    """``(level, node, before, word, child, ends)``: the edges of the phrases' trie from the second word on.

    A node is named by its words. ``before`` is the word that leads to ``node``, ``word`` the one that leads on, and
    ``ends`` tells whether ``child`` is a phrase itself.
    """
    words = F.split(F.trim("phrase"), r"\s+")
    listed = phrases.select(words.alias("words")).filter(F.size("words") > 1)
    levels = F.sequence(F.lit(2), F.size("words"))
    prefix = lambda n: F.array_join(F.slice("words", F.lit(1), n), " ")
    edges = listed.select("words", F.explode(levels).alias("level")).select(
        "level", prefix(F.col("level") - 1).alias("node"), F.element_at("words", F.col("level") - 1).alias("before"),
        F.element_at("words", F.col("level")).alias("word"), prefix(F.col("level")).alias("child"),
        (F.col("level") == F.size("words")).alias("ends"),
    )
    return edges.groupBy("level", "node", "before", "word", "child").agg(F.max("ends").alias("ends"))


def phrase_hits(documents: DataFrame, phrases: DataFrame) -> DataFrame:
    """Listed phrases of two or more words at every position, the longest one per position.

    A listed word fits a token as it is, in lower case, or capitalised. Every token goes out with the one behind
    it, whatever the longest phrase. Pairs that stand nowhere in the trie are left out in the first join; the
    levels after that join what is left of pairs with what is left of candidates, until no candidate goes on.
    """
    def beside(tokens: Column) -> Column:
        behind = F.slice(tokens, F.lit(2), F.size(tokens))
        return F.zip_with(tokens, behind, lambda w, n: F.struct(w.alias("w"), n.alias("next")))

    pairs = documents.select("doc_id", F.posexplode(let(split_words(F.col("text")), beside)).alias("pos", "p"))
    pairs = pairs.select("doc_id", "pos", F.col("p.w").alias("w"), F.col("p.next").alias("next")).filter(F.col("next").isNotNull())
    pairs = pairs.withColumn("key", F.lower(F.concat_ws(" ", "w", "next")))

    def fits(word: Column, token: Column) -> Column:
        low = F.lower(token)
        return (word == token) | (word == low) | (word == upper_first(low))

    trie = stored(phrase_trie(phrases).withColumn("key", F.lower(F.concat_ws(" ", "before", "word"))), "trie")
    keys = trie.groupBy("key").agg(F.min("level").alias("first"), F.max("level").alias("last"))
    # both sides come straight from their tables, so AQE broadcasts a short list and splits a hot key
    met = stored(pairs.join(keys, "key"), "pairs")
    roots = trie.filter("level = 2").drop("level")
    found = met.filter("first = 2").join(roots, "key").filter(fits(F.col("before"), F.col("w")) & fits(F.col("word"), F.col("next")))
    level = stored(found.select("doc_id", "pos", F.lit(2).alias("n"), F.col("child").alias("node"), "ends"), "phrases")
    hits, ahead = [], met.filter("last > 2").select("doc_id", F.col("pos").alias("at"), "next", "key")
    deeper = trie.filter("level > 2").select("node", "word", "key", "child", F.col("ends").alias("_ends"))
    while not level.isEmpty():
        hits.append(level.filter("ends"))
        # the pair that begins with the last word so far leads to the next one
        going = level.select("doc_id", "pos", "n", "node", (F.col("pos") + F.col("n") - 1).alias("at"))
        found = going.join(ahead, ["doc_id", "at"]).join(deeper, ["node", "key"]).filter(fits(F.col("word"), F.col("next")))
        level = stored(found.select("doc_id", "pos", (F.col("n") + 1).alias("n"), F.col("child").alias("node"), F.col("_ends").alias("ends")), "phrases")
    if not hits:
        hits = [level]
    return reduce(DataFrame.unionByName, hits).groupBy("doc_id", "pos").agg(
        F.max(F.struct("n", F.col("node").alias("phrase"))).alias("longest")
    ).select("doc_id", "pos", "longest.n", "longest.phrase")


def resolve_overlaps(hits: DataFrame) -> DataFrame:
    """Of overlapping hits the leftmost stays, then the next one that starts behind it.

    Hits are first cut into clusters that do not touch each other; the left-to-right choice runs
    inside a cluster. Window and aggregation share one exchange of narrow rows.
    """
    w = W.partitionBy("doc_id").orderBy("pos")
    before = w.rowsBetween(W.unboundedPreceding, -1)
    reach = F.max(F.col("pos") + F.col("n")).over(before)
    clusters = hits.withColumn(
        "fresh", F.when(F.col("pos") >= F.coalesce(reach, F.lit(0)), 1).otherwise(0)
    ).withColumn("cluster", F.sum("fresh").over(w.rowsBetween(W.unboundedPreceding, 0)))
    span = F.struct("pos", "n", "phrase")
    start = F.struct(
        F.lit(-1).alias("end"),
        F.array().cast("array<struct<pos:int,n:int,phrase:string>>").alias("kept"),
    )
    kept = F.aggregate(
        F.array_sort(F.collect_list(span)),
        start,
        lambda acc, s: F.when(
            s["pos"] >= acc["end"],
            F.struct(
                (s["pos"] + s["n"]).alias("end"), F.concat(acc["kept"], F.array(s)).alias("kept")
            ),
        ).otherwise(acc),
        lambda acc: acc["kept"],
    )
    return (
        clusters.groupBy("doc_id", "cluster")
        .agg(kept.alias("kept"))
        .select("doc_id", explode_array("kept").alias("s"))
        .select("doc_id", "s.pos", "s.n", "s.phrase")
    )


def phrase_counts(documents: DataFrame, phrases: DataFrame) -> DataFrame:
    """How often each listed phrase is read when a text is scanned from left to right."""
    return (
        resolve_overlaps(phrase_hits(documents, phrases))
        .groupBy("phrase")
        .agg(F.count(F.lit(1)).alias("n"))
    )
