from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

from llm_frames import awkward, empty, rows

from plateflow.llm.frames import table
from plateflow.llm.resampling import bucket_counts, resample, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def runs(text, longest):
    found = WORD.findall((text or "").translate(LOWER))
    return found, [" ".join(found[i:i + k]) for k in range(1, longest + 1) for i in range(len(found) - k + 1)]


def brute(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    def counted(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in runs(t, longest)[1])

    s, t = counted(d[1] for d in docs), counted(target)
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    scored = []
    for doc_id, text in docs:
        found, features = runs(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append((doc_id, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(found)))
    able = sorted((r for r in scored if r[4] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(able[:percent * len(able) // 100])]
    left = able[len(drawn):] + [r for r in scored if r[4] < least]
    return Counter(drawn) + Counter((*r[:4], None) for r in left)


def result(df):
    assert df.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    return Counter(tuple(r) for r in df.collect())


def test_words_are_those_of_the_pattern():
    for text in ["", "A b-C", "x\0y\x7fz_1", "Größe ÄÖ é́ 中文　字  \u0085 🙂a", "İI'S"]:
        assert [w.decode() for w in words(text)] == WORD.findall(text.translate(LOWER))


def test_awkward_rows(spark):
    plain = [(r[0], r[1]) for r in rows()]
    target = spark.createDataFrame([(1, "the of and", "x"), (2, None, "x"), (3, "", "x"), (3, "", "x")], "item_id int, text string, score string")
    texts = ["the of and", None, "", ""]
    for options in ({"percent": 100}, {"percent": 50, "least_words": 2, "longest": 3, "buckets": 97},
                    {"percent": 40, "least_words": 0, "longest": 2, "seed": 7}):
        least = {k.replace("least_words", "least"): v for k, v in options.items()}
        assert result(resample(awkward(spark), target, **options)) == brute(plain, texts, **least)


def test_empty_tables(spark):
    target = spark.createDataFrame([("a b",)], "text string")
    assert resample(empty(spark), target).collect() == []
    plain = [(r[0], r[1]) for r in rows()]
    assert result(resample(awkward(spark), target.limit(0), percent=100)) == brute(plain, [], percent=100)
    assert bucket_counts(empty(spark)).collect() == []


def test_draws_follow_the_target(spark):
    """Documents in the target's words are drawn ahead of the others."""
    docs = spark.createDataFrame([(i, ("alpha beta " if i % 4 == 0 else "gamma delta ") * 15) for i in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([("alpha beta " * 50,)], "text string")
    drawn = [r.doc_id for r in resample(docs, target, percent=20).collect() if r["rank"]]
    assert len(drawn) == 80 and sum(i % 4 == 0 for i in drawn) > 72


def test_whole_table(spark, data_dir):
    docs, target = table(spark, data_dir, "documents"), table(spark, data_dir, "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert result(resample(docs, target)) == want
