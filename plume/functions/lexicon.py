"""Word lists. Stop words come from the lists Spark ML ships (the same files
``StopWordsRemover.loadDefaultStopWords`` reads), so Spark and the SQL oracle
share one source; the phrase rules' own lists are fixed values below."""

from __future__ import annotations

import functools
import glob
import os
import zipfile

# The dashboard's extra stop words, as listed there (the
# multi-word entries can never equal one token; kept for fidelity).
CUSTOM_STOP_WORDS = [
    "that", "this", "these", "those", "them", "they", "their", "theirs",
    "people", "anyone", "someone", "something", "anything", "everything",
    "which", "what", "where", "when", "who", "whom", "whose",
    "the us", "the model", "the future", "the world", "the company",
    "a lot", "lot", "thing", "things", "stuff", "way", "ways",
    "time", "times", "question", "thanks", "thank",
    "post", "comment", "thread", "subreddit", "user", "upvote",
    "anyone", "everyone", "someone", "nobody", "anybody", "somebody",
    "all", "some", "many", "few", "much", "none",
]

# Generic single words that may not start or end a phrase.
GENERIC_WORDS = [
    "data", "image", "model", "tool", "system", "code", "language",
    "result", "problem", "example", "project", "paper", "test",
    "work", "performance", "version", "feature", "issue", "user",
    "file", "application", "platform", "service", "product",
    "company", "technology", "solution", "method", "process",
    "source", "experience", "knowledge", "context", "inference",
    "search", "noise", "year", "day", "app", "human", "generation",
]

# Over-general phrases never reported.
EXCLUDED_PHRASES = ["artificial intelligence", "machine learning", "deep learning", "neural network"]

# AI topic vocabulary of the trend code and collector queries.
AI_KEYWORDS = ["gpt", "claude", "llm", "openai", "anthropic", "gemini",
               "chatgpt", "ai", "machine learning", "deep learning"]

# Small sentiment lexicon (our choice; the design names no lexicon).
POSITIVE_WORDS = ["good", "great", "excellent", "amazing", "love", "like", "best", "better",
                  "happy", "impressive", "useful", "helpful", "fast", "easy", "win", "wins",
                  "awesome", "nice", "cool", "perfect", "bon", "gut", "bueno", "excelente"]
NEGATIVE_WORDS = ["bad", "worse", "worst", "terrible", "awful", "hate", "slow", "broken",
                  "bug", "bugs", "fail", "fails", "failed", "wrong", "problem", "issue",
                  "poor", "useless", "hard", "mauvais", "schlecht", "malo", "error", "lost"]

# Languages we can vote on with Spark's stop lists.
LANGUAGES = {"en": "english", "de": "german", "es": "spanish", "fr": "french"}


def _mllib_jar() -> str | None:
    import pyspark

    base = os.path.join(os.path.dirname(pyspark.__file__), "jars")
    hits = sorted(glob.glob(os.path.join(base, "spark-mllib_*.jar")))
    return hits[0] if hits else None


@functools.lru_cache(maxsize=None)
def stop_words(language: str = "english") -> tuple[str, ...]:
    """Spark ML's default stop words for a language (lower case, file order)."""
    jar = _mllib_jar()
    if jar:
        with zipfile.ZipFile(jar) as z:
            raw = z.read(f"org/apache/spark/ml/feature/stopwords/{language}.txt").decode("utf-8")
        return tuple(w.strip() for w in raw.splitlines() if w.strip())
    from pyspark.ml.feature import StopWordsRemover

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def phrase_stop_words() -> list[str]:
    """English stop words + the custom list, de-duplicated, first seen order."""
    seen: dict[str, None] = {}
    for w in list(stop_words("english")) + CUSTOM_STOP_WORDS:
        seen.setdefault(w, None)
    return list(seen)
