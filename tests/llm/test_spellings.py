"""Personal data in other spellings than the base rules take."""

import random

from clinicmart.llm import personal


def test_spelled_addresses_and_phones_without_plus_are_found(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 9)))
    number = lambda n: "".join(rng.choices("0123456789", k=n))
    rows = []
    for _ in range(300):
        phone = f"{rng.randint(1, 99)} {number(3)} {number(7)}"
        rows.append(f"{word()} mail {word()}.{word()}@{word()}.{rng.choice(['com', 'org', 'de'])} {word()}")
        rows.append(f"{word()} phone +{phone} {word()}")
        rows.append(f"{word()} {word()} order {number(rng.randint(7, 10))} {word()}")
        rows.append(f"{word()} phone +{number(2)} {number(4)} {word()}")
    # Spellings in the texts that have no word in front used to be counterexamples only.
    rows += [f"{word()} {word()} {word()} (at) {word()} (dot) org {word()}" for _ in range(300)]
    planted = [
        ("write to anna.k (at) clinic (dot) org today", "email", "anna.k (at) clinic (dot) org"),
        ("reach bob[at]ward[dot]de now", "email", "bob[at]ward[dot]de"),
        ("my phone 49 301 5551235 after six", "phone", "49 301 5551235"),
    ]
    docs = spark.createDataFrame(list(enumerate(rows + [p[0] for p in planted])), "doc_id bigint, text string")
    detector = personal.learn(personal.labelled(docs))
    assert {"email", "phone"} <= detector.thresholds.keys()
    for text, kind, span in planted:
        base, spans = detector.spans(text)
        start = text.index(span)
        assert base == []
        assert [(s, e, k) for s, _, e, k in spans] == [(start, start + len(span), kind)], (text, spans)
    # A number without a word of its kind, and an ending that no host has, are left alone.
    for text in ("the order 30155512 was sent", "meet at noon dot 7 or so"):
        assert detector.spans(text)[1] == []
