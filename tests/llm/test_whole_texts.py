"""Whole texts in the classifier's calibration; joined encoding equal to the library."""

import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lyceum.llm import compression_classifier as classifier, packing


def test_joined_words_have_the_library_ids():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rnd = random.Random(4)
    letters = "abcdeABCIÉéßñÿstll"
    chunks = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 14))) for _ in range(3000)]
    chunks = sorted({*chunks, "!!", "a's", "x1y22", "<|endoftext|>", "İ", "éa", "ﬁn", "\x1c", " ", "日本"})
    wanted = [e.ids for e in tokenizer.encode_batch(chunks, add_special_tokens=False)]
    assert [list(ids) for ids in packing.chunk_encoder(tokenizer)(chunks)] == wanted
    assert packing.chunk_encoder(tokenizer)([]) == []


def test_calibration_sees_whole_texts(spark):
    rnd = random.Random(5)
    word = lambda kind: rnd.choice(["alpha", "beta", "gamma"] if kind else ["zzz", "qqq", "xxx"]) + str(rnd.randrange(99))
    rows = [(i, " ".join(word(i % 2) for _ in range(400))) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    # 500 bytes of a text go into a dictionary, but all of it into the calibration's features.
    model = classifier.fit(docs, labels, text_bytes=500, dictionary=2048)
    scorer = classifier.Scorer(model.good, model.bad)
    got = {r["doc_id"]: r["score"] for r in classifier.score(docs, model).collect()}
    x = np.array([scorer.features(text.encode()) for _, text in rows])
    plain = 1 / (1 + np.exp(-np.clip(classifier.spread_features(x) @ np.array(model.weights), -30, 30)))
    assert np.allclose([got[i] for i, _ in rows], plain, atol=1e-9)
    assert np.mean([(got[i] >= 0.5) == (i % 2 == 1) for i, _ in rows]) > 0.95


def test_labels_without_documents_and_texts_of_nothing(spark):
    docs = spark.createDataFrame([(1, "good text"), (2, None), (3, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(9, 1), (None, 0), (2, None)], "doc_id long, label int")
    scores = classifier.score(docs, classifier.fit(docs, labels)).collect()
    assert len(scores) == 3 and all(0 <= r["score"] <= 1 for r in scores)
