"""Texts of far over 100,000 characters go through every operator whole; and the set of languages against all sets."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from reelspark.llm import audio, byte_bpe, chat_format, decontamination, language_id, near_copies, pii, quality_rules, simhash, substring_dedup, token_counts


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(21)
    word = lambda: "".join(rng.choices("abcdefghij", k=rng.randint(2, 9)))
    words = [word() for _ in range(30_000)]
    prose = " ".join(w + ("." if i % 11 == 10 else "") for i, w in enumerate(words))
    mixed = "é漢😀 x" * 26_000
    solid = "".join(rng.choices("0123456789abcdef", k=120_000))
    assert min(map(len, (prose, mixed, solid))) > 100_000
    return [prose, mixed, solid, prose + " and an end of its own"]


@pytest.fixture(scope="module")
def long_docs(spark, texts):
    return spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(2)


def test_tokens_and_bpe(long_docs, texts):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    found = {r.doc_id: (r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(long_docs, P.path("word_bpe_49k.json")).collect()}
    assert found == {i: (len(t.encode()), len(model.encode(t, add_special_tokens=False))) for i, t in enumerate(texts)}
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in byte_bpe.round_trip_digests(long_docs, P.path("byte_bpe_50k.tiktoken")).collect():
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, own.encode_ordinary(texts[r.doc_id]))).encode()).hexdigest() and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_chat(spark, texts):
    rows = [(0, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(texts)]
    turns = chat_format.canonical_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = chat_format.read_back(chat_format.format_turns(turns)).first()
    assert got.n_turns == 4 and got.loss_chars == len(texts[1]) + len(texts[3]) and got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows).encode()).hexdigest()


def test_pii_and_rules(spark, long_docs, texts):
    private = texts[0] + " write to a.b@c.org " + texts[0] + " Mr. John Smith. " + texts[0] + " John Smith"
    text = pii.replace_entities(spark.createDataFrame([(1, private)], "doc_id long, text string"), "k").first().text
    assert "a.b@c.org" not in text and "Smith" not in text and text.count(texts[0]) == 3
    found = {r.doc_id: (r.n_words, r.word_chars) for r in quality_rules.apply_rules(long_docs.withColumn("source", long_docs["text"].substr(1, 3))).collect()}
    assert found == {i: (len(t.split()), len("".join(t.split()))) for i, t in enumerate(texts)}


def test_duplicates(long_docs, texts):
    done = {r.doc_id: r for r in substring_dedup.remove_repeats(long_docs).collect()}
    assert bytes(done[0].kept) == texts[0].encode() and bytes(done[3].kept) == b" and an end of its own"
    prints = {r.doc_id: r for r in simhash.near_duplicates(long_docs).collect()}
    assert {i: r.fingerprint for i, r in prints.items()} == {i: f"{simhash.fingerprint(t.encode()):016x}" for i, t in enumerate(texts)}
    assert prints[3].component_id == 0 and prints[1].component_id == 1
    near = {r._id: r.component_id for r in near_copies.near_copies(long_docs).collect()}
    assert near == {0: 0, 1: 1, 2: 2, 3: 0}


def test_languages_decontamination_media(spark, long_docs, texts):
    train = spark.createDataFrame([("the of and to in is it was for on " * 50, "en"), ("der die und das nicht ist ein zu mit " * 50, "de")], "text string, lang string")
    found = language_id.identify(spark.createDataFrame([(1, "und das ist nicht der " * 8000)], "doc_id long, text string"), language_id.fit(train)).first()
    assert found.lang_pred == "de"
    words = texts[0].split()
    bench = spark.createDataFrame([("a", " ".join(words[29_000:29_020]))], "item_id string, text string")
    hits = {r.doc_id: r.n_hit for r in decontamination.digests(decontamination.hit_words(long_docs, bench)).collect()}
    assert hits == {0: 20, 1: 0, 2: 0, 3: 20}
    media = {r.doc_id: r for r in audio.features(audio.encode(audio.text_payload(long_docs))).collect()}
    for i, t in enumerate(texts):
        payload = t.encode().ljust(-(-len(t.encode()) // 64) * 64, b"\0")
        assert media[i].payload_sha256 == hashlib.sha256(payload).hexdigest() and media[i].tail_crc32 == zlib.crc32(payload[-64:])


def test_the_set_of_languages_against_all_sets():
    """The set that is kept has the best penalised likelihood of all sets that leaving out languages leads to, mostly of all."""
    rng = random.Random(2)
    said = {lang: ["".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(60)] for lang, letters in (("a", "abcdef"), ("b", "defghi"), ("c", "ghijkl"), ("d", "jklmno"))}
    texts, langs = [], sorted(said)
    counts = np.zeros((4, language_id.BUCKETS))
    for k, lang in enumerate(langs):
        grams, _, _ = language_id.words_and_grams([" ".join(rng.choices(said[lang], k=4000))])
        counts[k] = np.bincount(grams, minlength=language_id.BUCKETS)
    model = language_id.Model(langs, counts)
    for _ in range(30):
        used = rng.sample(langs, rng.randint(1, 3))
        texts.append(" ".join(w for lang in used for w in rng.choices(said[lang], k=rng.randint(10, 60))))
    shares = model.infer(texts)
    same = 0
    for text, share in zip(texts, shares):
        grams, first, _ = language_id.words_and_grams([text])
        logs = np.add.reduceat(model.logs[grams], first, axis=0).astype(float)
        scores = {}
        for n in range(1, 5):
            for some in itertools.combinations(range(4), n):
                own, part = np.exp(logs[:, some] - logs.max(axis=1)[:, None]), np.full(n, 1 / n)
                for _ in range(3000):
                    told = own * part
                    part = (told / told.sum(axis=1, keepdims=True)).mean(axis=0)
                scores[some] = np.log((own * part).sum(axis=1) + 1e-300).sum() - language_id.PENALTY * np.log(len(logs) + 1.0) * n
        kept = tuple(np.flatnonzero(share > 0).tolist())
        best = max(scores, key=scores.get)
        same += kept == best
        assert scores[kept] >= max(v for k, v in scores.items() if set(k) < set(kept) and len(k) == len(kept) - 1) - 1e-3 if len(kept) > 1 else True
    assert same >= 28
