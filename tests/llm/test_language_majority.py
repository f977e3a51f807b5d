"""The language stage of the pipeline leaves out what no language has the majority of; words are looked up once."""

import re

from pyspark.sql import functions as F

from tidemark.llm import language, tokenize


def test_texts_without_a_majority_language_go(spark):
    from tidemark.llm.tables import ship_code

    ship_code(spark)
    words = {"en": "the cat sat with them", "de": "zwölf boxkämpfer jagen viktor", "fr": "où l'élève façonna çà"}
    rows = [(100 * k + n, " ".join([text] * 5), lang) for k, (lang, text) in enumerate(words.items()) for n in range(6)]
    mixed = (900, " ".join(words.values()), "en")
    docs = spark.createDataFrame([*rows, mixed, (901, "ЖЖЖ ЩЩЩ ЫЫЫ", "en"), (902, "123", "en")], "doc_id long, text string, lang string")
    kept = {r.doc_id for r in language.keep_identified(docs).collect()}
    assert {i for i, _, _ in rows} <= kept
    assert not kept & {900, 901, 902}
    scores = language.identify(docs, language.learn(docs)).filter(F.col("score") >= language.MAJORITY)
    assert kept == {r.doc_id for r in scores.collect()}


def test_unusual_texts_are_those_of_the_pattern():
    pattern = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200d\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]|<\\|")
    for code in [*range(0x3100), *range(0xFE00, 0x10010)]:
        if not 0xD800 <= code < 0xE000:
            text = f"a{chr(code)}b"
            assert tokenize._is_unusual(text) == bool(pattern.search(text))
    assert tokenize._is_unusual("é <|x") and not tokenize._is_unusual("é < |x")


def test_known_and_new_words_keep_their_order():
    texts = ["one two", "one", "two three\xa0four", "", "five one", "two one"]
    tokenizer = tokenize.CachedTokenizer(tokenize.default_vocabulary())
    first = list(tokenizer.encode(texts))
    assert first == [tokenizer._whole([t])[0] for t in texts]
    assert list(tokenizer.encode(["six", *texts])) == [tokenizer._whole([t])[0] for t in ["six", *texts]]
