"""What languages are learned from, and what is predicted where none explains a text."""

import numpy as np

from clinicmart.llm import language


def test_a_label_of_nearly_only_copies(spark):
    own = [f"ein text nummer {w} mit eigenen worten" for w in ("eins", "zwei", "drei", "vier", "neun")]
    other = [f"some {w} words that stand for english" for w in ("few", "more", "good", "plain")]
    distinct = [("de", t) for t in own] + [("en", t) for t in other]
    # Whichever of the texts is copied, its hash is low or high.
    for copied in own:
        rows = distinct + [("de", copied)] * 400
        docs = spark.createDataFrame(rows, "lang string, text string")
        names, table = language.train(docs, train_docs=5)
        once = language.train(spark.createDataFrame(distinct, "lang string, text string"), train_docs=5)
        assert names == once[0] == ["de", "en"]
        assert np.array_equal(table, once[1])


def test_a_text_of_noise_has_a_learned_language(spark):
    rows = [("de", "eins zwei drei vier fünf sechs sieben"), ("en", "the quick brown fox jumps over it")]
    model = language.train(spark.createDataFrame(rows, "lang string, text string"))
    # The last but one is mostly unseen, with a trigram of English here and there.
    texts = ["Ξεσκεπάζω την ψυχοφθόρα", "zzgqj", "q", "xkcdq fox xkcdq zzgqj kkqxw pppqj", "12 !!", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.id: r for r in language.identify(docs, model).collect()}
    for i in range(4):
        assert found[i].lang_pred in ("de", "en") and 0 < found[i].score <= 1
    # Nothing speaks for either language, so they are equally likely; the pipeline sees the noise.
    assert found[0].lang_pred == "de" and abs(found[0].score - 0.5) < 1e-6
    assert found[0].noise > 0.99 and found[0].langs == []
    assert found[3].lang_pred == "en"
    for i in range(4, 7):
        assert (found[i].lang_pred, found[i].score) == ("und", 0.0)
