"""The pipeline against a brute-force version of all its stages, on a small fixture."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = r"[^\x20\x09-\x0D]+"
PHRASES = "licensed under|is licensed|all rights reserved|terms of service|terms of use|privacy policy|cookie policy|accept cookies|use of cookies|click here|read more|sign up|log in|subscribe to|share this|follow us|back to top|skip to content|javascript|lorem ipsum"


def sentence(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice(("an", "er", "th", "ou", "é")) for _ in range(r.randint(1, 4))) for _ in range(n)) + "."


def fixture():
    r, rows = random.Random(12), []
    for k in range(40):
        text = "\n".join(sentence(r, 20) for _ in range(6))
        rows.append((k, text, r.choice("abc")))
        if k % 4 == 0:
            rows.append((100 + k, text, r.choice("abc")))  # exact copy
        if k % 4 == 1:
            rows.append((150 + k, "Home | About | Login\n" + text + "\nread more", "a"))  # equal once it is clean
        if k % 5 == 0:
            rows.append((200 + k, text + "\n" + sentence(r, 5), "a"))  # near copy
    rows += [(300, None, "a"), (301, "", None), (302, "Home | About | Login | Help |\n" * 30, "b"), (303, "too short.", "c"), (304, sentence(r, 70), None)]
    rows += [rows[0], rows[0], rows[7]]  # repeated rows
    return [(i, t, "en", s, len(t or "")) for i, t, s in rows]


def cleaned(text):
    """The text without failing lines, or None: from the definitions, without the code under test."""
    words = re.findall(WORD, text or "")
    threes = collections.defaultdict(list)
    for k in range(len(words) - 2):
        threes[tuple(words[k : k + 3])].append(k)
    repeated = {k + d for at in threes.values() if len(at) > 1 for k in at for d in range(3)}
    if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
        return None
    kept, lost = [], 0
    for line in text.split("\n"):
        own = re.findall(WORD, line)
        bars = sum(line.count(c) for c in "|»›")
        ended = own and own[-1][-1] in ".!?:;,\"')]}”’»…。！？"
        cut = len(own) >= 30 and re.search(r"[.!?][\x20\x09-\x0D]", line.strip("\x20\x09\x0a\x0b\x0c\x0d"))
        if own and ((len(own) >= 4 and not ended and not cut) or (bars >= 3 and 4 * bars >= len(own)) or (len(own) <= 40 and re.search(PHRASES, line.lower()))):
            lost += sum(map(len, own))
        else:
            kept.append(line)
    return "\n".join(kept) if lost <= 0.5 * sum(map(len, words)) else None


def shingle_set(text):
    words = [w.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for w in re.findall(WORD, text)]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    docs = {i: (cleaned(t), s) for i, t, _, s, _ in rows if cleaned(t) is not None}
    last = {}
    for i in sorted(docs):
        last[docs[i][0]] = i
    docs = {i: d for i, d in docs.items() if last[d[0]] == i}
    sets = {i: shingle_set(t) for i, (t, _) in docs.items()}
    part = {i: i for i in docs}
    for _ in docs:
        for i in docs:
            for j in docs:
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    part[i] = part[j] = min(part[i], part[j])
    docs = {i: d for i, d in docs.items() if part[i] == i}
    size = collections.Counter()
    for t, s in docs.values():
        size[s] += len(t)
    weight = {s: n**0.5 for s, n in size.items()}
    library, out = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), []
    for i, (t, s) in docs.items():
        rate = weight[s] / sum(weight.values()) * sum(size.values()) / size[s]
        draw = (int(hashlib.md5(f"count17:{i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        copies, p = 0, math.exp(-rate)
        total = p
        while total < draw:
            copies += 1
            p *= rate / copies
            total += p
        ids = library.encode(t, add_special_tokens=False).ids
        out += [(i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())] * copies
    return sorted(out)


def test_pipeline(spark, tmp_path):
    rows = fixture()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    done = corpus_pipeline.run(spark, str(tmp_path))
    got, want = sorted(tuple(r)[:4] for r in done.collect()), brute_force(rows)
    assert got == want and len({i for i, *_ in got} & {151, 155, 159}) > 0


def test_stages_keep_columns(spark):
    docs = spark.createDataFrame(fixture(), SCHEMA)
    more = ("_id", "_digest", "_own", "_copy", "_n_copies", "_cdf", "_source_key", "_draw", "_shuffle_key", "doc", "digest", "component", "kept", "key")
    docs = docs.select("*", *(F.concat(F.lit(c), F.col("doc_id").cast("string")).alias(c) for c in more))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == columns, name
        assert all(r[c] == f"{c}{r.doc_id}" for r in docs.collect() for c in more) and docs.filter("n_chars != length(text)").isEmpty(), name


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
