"""The classifier and the pipeline's stages against plain Python, and the stages on odd rows."""

import hashlib
import math
import random
import re

import public_tokenizers
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from verlog.llm import bpe, quality
from verlog.sources.testdata import table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# ---------------------------------------------------------------- classifier
def shape(token):
    if not (token[0].isalnum() or token[0] == "_"):
        return token[:4]
    if token.isdigit():
        return "0"
    if token.isupper() and len(token) > 1:
        return "AA"
    if token.islower():
        return "a"
    return "Aa" if token[0].isupper() and token[1:].islower() or len(token) == 1 else "aA"


def grams(text):
    """Buckets of a text's n-grams: words to pairs, shapes to triples, a shape marked if its word came up to four before."""
    m64 = (1 << 64) - 1
    found = re.findall(r"\w+|[^\w\s]+", text or "")
    words = [xxhash.xxh64_intdigest(t.lower()) for t in found]
    shapes = [xxhash.xxh64_intdigest(shape(t), 1) ^ (0xA5A5A5A5A5A5A5A5 if words[i] in words[max(i - 4, 0):i] else 0)
              for i, t in enumerate(found)]
    out = []
    for hashes, n, salt in ((words, 1, 1), (words, 2, 2), (shapes, 1, 3), (shapes, 2, 4), (shapes, 3, 5)):
        for i in range(len(hashes) - n + 1):
            x = salt
            for h in hashes[i:i + n]:
                x = (x ^ h) * 0x9E3779B97F4A7C15 & m64
                x ^= x >> 29
            out.append((x * 0xC2B2AE3D27D4EB4F & m64) >> 50)
    return out


def kept_by_hand(spark, docs, labels, seed=42):
    """(doc_id, n, mean, kept) of every row; docs have unique ids."""
    good = {}
    for i, q in labels:
        good[i] = min(good.get(i, q), q)
    lists = {r.doc_id: grams(r.text) for r in docs.collect()}
    raw, target, size = {}, {}, 1 << 14
    for i, found in lists.items():
        for b in found:
            raw[b] = raw.get(b, 0) + 1
            if good.get(i, 0) > 0:
                target[b] = target.get(b, 0) + 1
    n_raw, n_target = sum(raw.values()), sum(target.values())

    def ratio(b):
        return (math.log((target.get(b, 0) + 0.5) / (n_target + 0.5 * size)) - math.log((raw.get(b, 0) + 0.5) / (n_raw + 0.5 * size)))

    mean = {i: sum(map(ratio, x)) / len(x) if x else 0.0 for i, x in lists.items()}
    known = sorted((mean[i], q > 0) for i, q in good.items() if lists.get(i))
    cuts = [known[0][0] - 1, *[(a[0] + b[0]) / 2 for a, b in zip(known, known[1:])], known[-1][0] + 1]
    n_good, n_bad = sum(g for _, g in known), sum(not g for _, g in known)
    right = [sum(not g for _, g in known[:k]) / n_bad + sum(g for _, g in known[k:]) / n_good for k in range(len(known) + 1)]
    best = [k for k, r in enumerate(right) if r >= max(right) - 1e-12]
    floor = cuts[best[len(best) // 2]]
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64(F.lit(seed), "doc_id", "text").alias("h")).collect()}
    key = {i: len(x) * (mean[i] - floor) - math.log(-math.log((((hashes[i] & (1 << 64) - 1) >> 11) + 0.5) / (1 << 53)))
           for i, x in lists.items() if x}
    k = sum(mean[i] >= floor for i in key)
    chosen = set(sorted(key, key=key.get, reverse=True)[:k])
    return {i: (len(x), mean[i], i in chosen) for i, x in lists.items()}


def test_classifier_against_plain_python(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").select("doc_id", "quality")
    want = kept_by_hand(spark, docs, [tuple(r) for r in labels.collect()])
    got = quality.quality_scores(docs, labels, carry=["doc_id"]).collect()
    assert len(got) == len(want) and any(w[2] for w in want.values()) and not all(w[2] for w in want.values())
    for r in got:
        n, mean, kept = want[r.doc_id]
        assert r.n_grams == n and abs(r.log_ratio - mean) < 1e-9 and r.kept == kept, r.doc_id


# ---------------------------------------------------------------- stages
def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_of_groups(ids, linked):
    lead = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if linked(a, b) and lead[a] != lead[b]:
                    lead[a] = lead[b] = min(lead[a], lead[b])
                    changed = True
    return {i for i in ids if lead[i] == i}


def test_pipeline_against_plain_python(spark):
    import tiktoken

    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels").select("doc_id", "quality")
    text = {r.doc_id: r.text for r in docs.collect()}
    by_hand = kept_by_hand(spark, docs, [tuple(r) for r in labels.collect()])
    good = sorted(i for i, w in by_hand.items() if w[2])

    stage = corpus_pipeline.quality(spark, docs, SF)
    assert sorted(r.doc_id for r in stage.collect()) == good

    plain = {i: re.sub(r"[\x20\x09-\x0D]+", " ", text[i] or "") for i in good}
    single = sorted({plain[i]: i for i in reversed(good)}.values())
    stage = corpus_pipeline.exact_copies(spark, corpus_pipeline.stage(stage, "test"), SF)
    assert sorted(r.doc_id for r in stage.collect()) == single

    prints = {i: fingerprint(text[i]) for i in single}
    near = sorted(smallest_of_groups(single, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4))
    stage = corpus_pipeline.near_copies(spark, corpus_pipeline.stage(stage, "test"), SF)
    assert sorted(r.doc_id for r in stage.collect()) == near

    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text[i] or "")) for i in near}
    source = {r.doc_id: r.source for r in docs.collect()}
    names = sorted({source[i] for i in near}, key=lambda x: (x is None, x or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    room = {s: sum(size[i] for i in near if source[i] == s) for s in names}
    goal, left, free = {}, 1.5 * sum(size.values()), set(names)
    while True:
        shares = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if shares[s] > 2 * room[s]}
        if not over:
            goal.update(shares)
            break
        for s in over:
            goal[s] = 2.0 * room[s]
            left -= goal[s]
        free -= over
    mixed = corpus_pipeline.stage(corpus_pipeline.mix(spark, corpus_pipeline.stage(stage, "test"), SF), "test")
    times = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert set(times) <= set(near) and max(times.values()) <= 2
    for s in names:
        took = sum(times.get(i, 0) * size[i] for i in near if source[i] == s)
        assert abs(took - goal[s]) <= max(size[i] for i in near if source[i] == s), s

    tool = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.load_ranks(
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    for r in corpus_pipeline.encode(spark, mixed, SF).collect():
        ids = tool.encode_ordinary(text[r.doc_id] or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text[r.doc_id] or "").encode()).hexdigest())


def test_stages_on_odd_rows(spark, tmp_path):
    rnd = random.Random(2)
    some = ["", None, "Some plain words, in a row, as they come.", "some plain  words, in a row, as they come.", "x",
            "word, and " * 30_000, "Zwei Sätze. Noch einer!", "\n\t "]
    rows = [(rnd.choice([None, k, k // 3]), rnd.choice(some), rnd.choice([None, "en", ""]), rnd.choice([None, "a", "b"]),
             rnd.choice([None, 4]), "c", 0.5, k) for k in range(40)]
    rows += rows[:5]
    names = DOCS + ", fp string, kept double, `log_ratio.x` bigint"
    frame = spark.createDataFrame(rows, names)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 0), (5, None)], "doc_id bigint, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (frame, frame.limit(0)):
        n = docs.count()
        for name, step in corpus_pipeline.STAGES:
            out = step(spark, docs, str(tmp_path)).collect()
            assert len(out) <= 2 * n, name
            if name == "encode":
                assert len(out) == n and sorted(str(r.doc_id) for r in out) == sorted(str(r[0]) for r in docs.collect())
                continue
            given = {tuple(r) for r in docs.collect()}
            assert all(tuple(r) in given for r in out), name
            assert step(spark, docs, str(tmp_path)).columns == docs.columns
            if n and name == "exact_copies":
                texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
                assert len(out) == len(set(texts))
            if n and name == "quality":
                assert all((r.text or "").strip() for r in out)
