"""Queries that SQL cannot express: topic model and word pieces."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import artm, sharded, wordpiece
from tidemark.plans import views
from tidemark.scratch import stored

ORACLES: dict[str, str] = {}


def topic_pipeline(spark, d):
    """Fit on the words of all documents, then weights of every document."""
    s = artm.Settings(topics=10, passes=10, smooth_phi=0.01, decorrelate=0.01)
    bow = stored(views.doc_words(spark, d).select("doc_id", "word", "tf"), "words")
    return artm.transform(bow, artm.fit(bow, s), s)


def topic_model_sharded(spark, d):
    """Words' weights after two passes of a model whose phi is a table, fitted on the words of all documents."""
    s = artm.Settings(topics=20, passes=2, smooth_phi=0.01, decorrelate=0.01)
    bow = stored(views.doc_words(spark, d).select("doc_id", "word", "tf"), "words")
    return sharded.fit(bow, s).phi()


def word_pieces(spark, d):
    """Pieces of every document over a vocabulary of letters and frequent beginnings."""
    letters = [chr(c) for c in range(97, 123)] + list("äöüßéèêçáíóúñ0123456789.,!?-|*$%&#=\"@+()'")
    vocab = letters + ["##" + c for c in letters] + ["the", "of", "and", "##er", "##en", "##tion", "th", "##ed", "##ing"]
    out = wordpiece.tokenize(views.docs(spark, d), vocab)
    return out.select("doc_id", F.size("tokens").alias("n_pieces"), F.array_join("tokens", " ").alias("pieces"))


QUERIES = {"topic_pipeline": topic_pipeline, "topic_model_sharded": topic_model_sharded, "wordpiece": word_pieces}
