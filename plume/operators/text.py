"""Text analytics (K1–K4, K6, K8, P12–P14, U1, F10): all per-row array work
plus hash aggregates – no corpus ever meets in one task or on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as L
from ..functions import text as T
from ..session import Workspace

# Sentence punctuation: phrase candidates never cross it.
SENTENCE_SPLIT = r"[.!?;:]+|\n"
WORD_SPLIT = r"[^\p{L}\p{N}_]+"


def _lits(words) -> list[Column]:
    return [F.lit(w) for w in words]


def word_tokens(text) -> Column:
    """Lower-case word tokens (split on anything that is not a word char)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(c), WORD_SPLIT), lambda w: w != "")


def token_line(text) -> Column:
    """`` tok1 tok2 … `` with blanks at both ends: whole-word and multi-word
    matching becomes a plain substring test (no regex word boundaries,
    which differ between regex engines for non-ASCII letters)."""
    return F.concat(F.lit(" "), F.array_join(word_tokens(text), " "), F.lit(" "))


def matches_any(text, terms) -> Column:
    """Any term (word or phrase) occurs as whole words, case-insensitive."""
    line = token_line(text)
    conds = [F.contains(line, F.lit(f" {t.lower()} ")) for t in terms]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def matched_terms(text, terms) -> Column:
    """K2: the terms (in list order) that occur in the text, as an array.
    The token line is bound to a lambda variable, so it is built once a row
    however many terms there are; each term is one substring test."""
    def hits(line):
        return F.filter(F.array(*[F.when(F.contains(line, F.lit(f" {t.lower()} ")), F.lit(t.lower())) for t in terms]),
                        lambda k: k.isNotNull())

    return F.element_at(F.transform(F.array(token_line(text)), hits), 1)


def with_topics(posts: DataFrame, terms=None, text: str = "text_clean", hashtags: str = "hashtags") -> DataFrame:
    """Adds ``topics``: the vocabulary's terms in the text (K2, by default the
    AI vocabulary) and the lower-cased hashtags, each once."""
    found = matched_terms(F.coalesce(F.col(text), F.lit("")), list(terms or L.AI_KEYWORDS))
    return posts.withColumn("topics", F.array_union(found, F.transform(hashtags, lambda h: F.lower(h))))


def enrich_posts(posts: DataFrame, terms=None, pos=None, neg=None, text: str = "text_clean") -> DataFrame:
    """P8 and the enriched silver columns: posts with text only (neither null
    nor blank), with ``topics``, ``sentiment`` and the ``detected`` language.
    Row-wise work, no shuffle."""
    worded = posts.where(F.col(text).isNotNull() & F.col(text).rlike(rf"[^{T.BLANK}]"))
    scored = sentiment(with_topics(worded, terms, text), text, pos, neg).drop("positive", "negative", "label")
    return detect_language(scored, text)


def first_term(text, terms) -> Column:
    """U1 in one pass: the first of the terms (list order) that occurs, else null."""
    return F.get(matched_terms(text, terms), F.lit(0))


def _segment_tokens(docs: DataFrame, text: str) -> DataFrame:
    """One row per sentence segment: URL-free, punctuation → blank (F9),
    lower-cased word tokens, maybe none: a filter on their number would make
    them twice. ``explode`` is a per-row generator: no shuffle."""
    no_url = F.regexp_replace(F.col(text), T.URL_PATTERN, "")
    segs = docs.select(F.explode(F.split(no_url, SENTENCE_SPLIT)).alias("seg"))
    toks = F.filter(F.split(F.trim(F.lower(T.drop_punct(F.col("seg")))), rf"[{T.BLANK}]+"), lambda w: w != "")
    return segs.select(toks.alias("t"))


def _candidates(seg: DataFrame, min_n: int, max_n: int, min_chars: int, stop, generic, excluded) -> DataFrame:
    """(kind, keyword): the kept phrases (kind 0) and fallback words (kind 1) of rows of segment tokens ``t``.

    Every token is judged once: ``m`` holds null in place of a stop word or number, ``x`` of a generic word too. A phrase
    begins and ends in ``x`` and has ``m`` between; a null makes the whole of it null. Each place is a row with its
    followers, so phrases are put together by compiled code, not element by element."""
    judged = seg.select(F.transform("t", lambda w: F.when(~(w.isin(stop) | w.rlike(r"^\p{Nd}+$")), w)).alias("m"))
    judged = judged.select("m", F.transform("m", lambda w: F.when(~w.isin(generic), w)).alias("x"))
    places = judged.select(F.inline(F.arrays_zip(
        *[F.slice(c, j + 1, F.size("m")).alias(f"{c}{j}") for c in ("m", "x") for j in range(max_n)])))
    grams = [F.concat(F.col("x0"), *[part for j in range(1, n) for part in (F.lit(" "), F.col(f"{'m' if j < n - 1 else 'x'}{j}"))])
             for n in range(min_n, max_n + 1)]
    word = F.when((F.length("x0") >= 4) & F.col("x0").rlike(r"^\p{L}+$") & ~F.col("x0").startswith("ai"), F.col("x0"))
    found = places.where("x0 IS NOT NULL").select(F.inline(F.array(
        *[F.struct(F.lit(0).alias("kind"), g.alias("keyword")) for g in grams], F.struct(F.lit(1).alias("kind"), word.alias("keyword")))))
    phrase = (F.length("keyword") >= min_chars) & ~F.col("keyword").isin(excluded)
    return found.where(F.col("keyword").isNotNull() & ((F.col("kind") == 1) | phrase))


def _lists(stop, generic, excluded):
    return (list(stop if stop is not None else L.phrase_stop_words()),
            list(generic if generic is not None else L.GENERIC_WORDS),
            list(excluded if excluded is not None else L.EXCLUDED_PHRASES))


def _top(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("mentions"), F.asc("keyword")).limit(n)


def keyword_topn(docs: DataFrame, text: str = "text", top_n: int = 20, min_phrases: int = 5) -> DataFrame:
    """Top-n phrases; when fewer than ``min_phrases`` phrases exist,
    single words are merged in and the union re-ranked and cut.

    One scan and one tokenisation feed both candidate kinds: each segment
    yields (kind, keyword) pairs, counted by a partial aggregate (the shuffle
    carries (kind, keyword, partial count) only); the top n per kind come
    from a map-side group limit. The fallback decision runs over at most
    2·n rows (no driver round trip).
    """
    stop, generic, excluded = _lists(None, None, None)
    counts = (_candidates(_segment_tokens(docs, text), 2, 4, 8, stop, generic, excluded)
              .groupBy("kind", "keyword").agg(F.count(F.lit(1)).alias("mentions")))
    per_kind = Window.partitionBy("kind").orderBy(F.desc("mentions"), F.asc("keyword"))
    both = counts.withColumn("_r", F.row_number().over(per_kind)).where(F.col("_r") <= top_n).drop("_r")
    n_phr = F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).over(Window.partitionBy())
    # Later (word) count wins on a key clash – a phrase has a blank, a word
    # has none, so the clash cannot happen; the rule is kept for fidelity.
    merged = (both.withColumn("_np", n_phr)
              .where((F.col("kind") == 0) | (F.col("_np") < min_phrases)))
    pick = Window.partitionBy("keyword").orderBy(F.desc("kind"))
    merged = merged.withColumn("_r", F.row_number().over(pick)).where(F.col("_r") == 1)
    return _top(merged.select("keyword", "mentions"), top_n)


def cloud_weights(docs: DataFrame, text: str = "text", top_n: int = 100, max_words: int = 50) -> DataFrame:
    """K8: top phrases as one-line text with weight = mentions / max mentions,
    best ``max_words`` kept (the window runs over ≤ top_n rows)."""
    top = keyword_topn(docs, text, top_n)
    best = top.select(T.collapse_ws(F.col("keyword")).alias("keyword"), "mentions") \
              .orderBy(F.desc("mentions"), F.asc("keyword")).limit(max_words)
    return best.withColumn("weight", F.round(F.col("mentions") / F.max("mentions").over(Window.partitionBy()), 4))


def topic_mentions(docs: DataFrame, terms, text: str = "text", key: str = "doc_id") -> DataFrame:
    """K2: one row per (document, matched topic) – explode after an in-array
    filter, so documents without a topic produce nothing."""
    return docs.select(key, F.explode(matched_terms(F.col(text), terms)).alias("topic"))


def topic_counts(mentions: DataFrame) -> DataFrame:
    """T5 input: documents per topic."""
    return mentions.groupBy("topic").agg(F.count(F.lit(1)).alias("mentions"))


def sentiment(docs: DataFrame, text: str = "text", pos=None, neg=None, margin: float = 0.05) -> DataFrame:
    """K3: lexicon score = (positive − negative hits) / tokens, label by margin.
    Lists are a few dozen words: ``isin`` becomes a hash-set test (InSet)."""
    pos = list(pos or L.POSITIVE_WORDS)
    neg = list(neg or L.NEGATIVE_WORDS)
    toks = word_tokens(F.col(text))
    p = F.size(F.filter(toks, lambda w: w.isin(pos)))
    n = F.size(F.filter(toks, lambda w: w.isin(neg)))
    score = F.when(F.size(toks) > 0, (p - n) / F.size(toks)).otherwise(F.lit(0.0))
    return docs.select("*", p.cast("bigint").alias("positive"), n.cast("bigint").alias("negative"),
                       F.round(score, 4).alias("sentiment")) \
        .withColumn("label", F.when(F.col("sentiment") > margin, "positive")
                    .when(F.col("sentiment") < -margin, "negative").otherwise("neutral"))


def _count_in(toks: Column, words) -> Column:
    words = list(words)
    return F.size(F.filter(toks, lambda w: w.isin(words)))


def detect_language(docs: DataFrame, text: str = "text", languages=None) -> DataFrame:
    """K4: stop-word vote per language (Spark's stop lists) plus a CJK share
    test for Chinese; ties go to the first language in list order, no hits
    give 'und'."""
    languages = dict(languages or L.LANGUAGES)
    toks = word_tokens(F.col(text))
    votes = [_count_in(toks, L.stop_words(name)).alias(code) for code, name in languages.items()]
    c = F.coalesce(F.col(text), F.lit(""))
    cjk = F.length(F.regexp_replace(c, r"[^\p{IsHan}]", ""))
    scored = docs.select("*", F.struct(*votes).alias("_v"), cjk.alias("_cjk"), F.length(c).alias("_len"))
    best = F.lit(None).cast("string")
    best_n = F.lit(0)
    for code in languages:
        v = F.col(f"_v.{code}")
        best = F.when(v > best_n, F.lit(code)).otherwise(best)
        best_n = F.greatest(best_n, v)
    lang = (F.when((F.col("_len") > 0) & (F.col("_cjk") * 3 > F.col("_len")), F.lit("zh"))
            .otherwise(F.coalesce(best, F.lit("und"))))
    return scored.withColumn("detected", lang).drop("_v", "_cjk", "_len")


def extract_tags(docs: DataFrame, text: str = "text") -> DataFrame:
    """hashtags and mentions of each text, in text order."""
    return docs.select("*", T.extract_hashtags(F.col(text)).alias("hashtags"),
                       T.extract_mentions(F.col(text)).alias("mentions"))


# Fixed parameters of the related-document signature (ours).
MINHASH_FUNCS = 8
MINHASH_BAND = 2


def minhash_signature(text, n_funcs: int = MINHASH_FUNCS) -> Column:
    """K7: MinHash over the set of word tokens, one hash function per salt:
    h_i(w) = md5(i || ':' || w); the signature keeps the minimum per i.
    md5 is the same function in every engine, so signatures are portable.
    The words are bound to a lambda variable, so a text is split once."""
    def least(words):
        return F.array(*[F.array_min(F.transform(words, _salted_md5(i))) for i in range(n_funcs)])

    return F.element_at(F.transform(F.array(F.array_distinct(word_tokens(text))), least), 1)


def _salted_md5(i: int):
    return lambda w: F.md5(F.concat(F.lit(f"{i}:"), w))


def related_groups(docs: DataFrame, key: str = "doc_id", text: str = "text",
                   n_funcs: int = MINHASH_FUNCS, band: int = MINHASH_BAND) -> DataFrame:
    """K7: documents related by MinHash banding (LSH), as a group id.

    Each band of ``band`` signature values is a bucket; the group of a
    document is the smallest id among the documents sharing any of its
    buckets. Built from two aggregates (bucket → min id, document → min
    over its buckets): linear work on stored buckets, so texts are read and
    signed once, and no candidate *pairs* are ever formed, so a bucket holding millions of copies costs no more than its
    rows. Documents that share no bucket, and texts without words, are their
    own group. ``group_id`` is a bucket's head, one hop away: relation is not
    carried on from document to document."""
    # Without words the signature holds nulls.
    sig = docs.select(key, minhash_signature(F.col(text), n_funcs).alias("_s")).select(
        key, F.when(F.col("_s")[0].isNotNull(), F.col("_s")).otherwise(F.array(*[F.col(key).cast("string")] * n_funcs)).alias("sig"))
    bands = Workspace(docs.sparkSession, "bands").put(sig.select(key, F.posexplode(F.array(*[
        F.concat_ws("|", *[F.col("sig")[b * band + j] for j in range(band)])
        for b in range(n_funcs // band)])).alias("band", "bucket")))
    bucket_min = bands.groupBy("band", "bucket").agg(F.min(key).alias("_g"), F.count(F.lit(1)).alias("_n"))
    per_doc = (bands.join(bucket_min, ["band", "bucket"])
               .groupBy(key).agg(F.min("_g").alias("group_id"), F.max("_n").alias("bucket_size")))
    return per_doc.withColumn("related", F.col("bucket_size") > 1)


def collocations(docs: DataFrame, text: str = "text", top_n: int = 20, min_count: int = 5, stop=None, generic=None) -> DataFrame:
    """K1 nearer to noun phrases: word pairs that stand together more often than their words' counts explain, by the
    log-likelihood ratio of the pair's two-by-two table. Pairs never cross sentence punctuation, hold no stop or generic
    word, number or URL, and stand ``min_count`` times or more; each is counted as first and second word of all pairs.

    One pass gives the pairs; their words' counts are sums over the pair counts, so texts are read once. Rows: keyword,
    mentions, score (rounded to four places), best ``top_n`` by score, ties by keyword."""
    stop, generic, _ = _lists(stop, generic, None)
    seg = _segment_tokens(docs, text)
    good = F.transform("t", lambda w: ~(w.isin(stop) | w.isin(generic) | w.rlike(r"^\p{Nd}+$")))
    z = F.arrays_zip(F.col("t").alias("a"), F.slice("t", 2, F.size("t")).alias("b"), F.col("ok").alias("x"), F.slice("ok", 2, F.size("t")).alias("y"))
    pairs = seg.select("t", good.alias("ok")).select(F.explode(z).alias("z")).where("z.b IS NOT NULL AND z.x AND z.y")
    counts = pairs.groupBy(F.col("z.a").alias("a"), F.col("z.b").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    space = Workspace(docs.sparkSession, "pairs")
    counts = space.put(counts)
    rest = F.lit(counts.agg(F.sum("n")).first()[0] or 0)  # one number
    first = counts.groupBy("a").agg(F.sum("n").alias("na"))
    second = counts.groupBy("b").agg(F.sum("n").alias("nb"))
    table = counts.where(F.col("n") >= min_count).join(first, "a").join(second, "b")
    cell = lambda k, row, column: F.when(k > 0, k * F.log(k * rest / (row * column))).otherwise(F.lit(0.0))
    n, na, nb = F.col("n"), F.col("na"), F.col("nb")
    score = 2 * (cell(n, na, nb) + cell(na - n, na, rest - nb) + cell(nb - n, rest - na, nb)
                 + cell(rest - na - nb + n, rest - na, rest - nb))
    together = n * rest > na * nb  # more often than by chance
    out = table.where(together).select(F.concat_ws(" ", "a", "b").alias("keyword"), n.alias("mentions"), F.round(score, 4).alias("score"))
    return out.orderBy(F.desc("score"), F.asc("keyword")).limit(top_n)
