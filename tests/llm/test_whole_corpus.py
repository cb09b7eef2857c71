"""Operators on a corpus as a whole (collocations, repeated passages, resampling) against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sheaf.llm import bwt, collocations, importance, repeats

DOCS = "doc_id long, text string, lang string, score string, rank string, d int, anchor int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", "r", 1, 2) for i, t, lang in rows], DOCS)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def rows():
    """Copies, shared passages, nulls, empty, short and long texts, repeated rows and ids."""
    rng = random.Random(11)
    words = [*"alpha Beta gamma delta rho sigma tau phi chi psi".split(), "été", "x1", "日本"]
    passage = " ".join(rng.choice(words) + str(rng.randrange(99)) for _ in range(60))
    out = []
    for i in range(150):
        text = rng.choice(["", ". ", "!\n"]).join(" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 9]))) + rng.choice(["", ".", "\t"]) for _ in range(rng.randrange(9)))
        if i % 5 == 0:
            text = text[: len(text) // 2] + passage[rng.randrange(40) :] + text[len(text) // 2 :]
        out.append((i, text, rng.choice(["en", "fr", None])))
    big = "".join(rng.choice("abcdefgh ") for _ in range(700_000))
    out += [(200, None, "en"), (201, "", None), (202, passage, "und"), (203, passage, "fr"), (204, "z" * 400, "en"), (None, passage + " tail", "en"), (205, big + passage + big[600_000:], "de")]
    return [*out, out[3], out[5], (5, passage + " other text of the same id", "en")]


def brute_collocations(rows, least, cover=80, top=2000):
    counts, sizes = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\n-\r]", ascii_lower(text)):
            ws = [w for w in re.split(r"[ \t]+", piece) if w]
            sizes[lang] += len(ws)
            for n in range(1, 5):
                counts[lang].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        kept = []
        for g, a in found.items():
            inside = any(100 * b >= cover * a for h, b in found.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h) - len(g) + 1)))
            if not inside:
                score, k = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                kept.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, sizes[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.mark.parametrize("dictionary", [1 << 20, 0])
def test_collocations(spark, rows, monkeypatch, dictionary):
    monkeypatch.setattr(collocations, "DICTIONARY", dictionary)
    got = collocations.mine(frame(spark, rows), least=3, top=50)
    want = brute_collocations(rows, 3, top=50)
    assert len(want) > 40
    assert sorted(map(tuple, got.collect())) == want


def test_collocations_of_nothing(spark):
    assert collocations.mine(frame(spark, [])).count() == 0
    assert collocations.mine(frame(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_long_texts_are_cut_between_words():
    import pyarrow as pa

    text = "one two three " * 200_000 + "\nend"
    batch = pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([text])], names=["lang", "text"])
    parts = list(collocations._parts(batch))
    assert len(parts) > 2 and b"".join(p for _, p, _ in parts).decode() == text and [g for _, _, g in parts] == [False] + [True] * (len(parts) - 1)


def brute_repeats(rows):
    """By windows in the order of documents; ids and texts that repeat are one document."""
    seen, out = set(), {}
    for key, data in rows:
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 99):
            w = data[i : i + 100]
            if w in seen:
                gone[i : i + 100] = True
            seen.add(w)
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        out[key] = (len(data), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [1 << 15, 2])
def test_repeats(spark, rows, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = frame(spark, rows)
    keyed = repeats._keyed(docs).distinct().orderBy("d", "v").collect()
    want = brute_repeats([((r["doc_id"], r["v"]), (r["text"] or "").encode()) for r in keyed])
    by_id = defaultdict(set)
    for (doc_id, _), v in want.items():
        by_id[doc_id].add(v)
    got = repeats.dedup(docs).collect()
    assert len(got) == len(rows) and sum(r["n_removed"] for r in got) > 50_000
    assert all(tuple(r)[1:] in by_id[r["doc_id"]] for r in got)
    assert {r["doc_id"]: sum(1 for x in got if x["doc_id"] == r["doc_id"]) for r in got} == Counter(r[0] for r in rows)
    assert repeats.dedup(frame(spark, [])).count() == 0


def test_merged_transforms_are_those_of_all_strings():
    rng = random.Random(5)
    for depth in (1, 3, 8, 9, 12):
        for _ in range(30):
            shards = [[bytes(rng.choice(b"ab\x00") for _ in range(rng.choice([0, 2, 5, 14, 20]))) for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 4))]
            suffixes = [s[k:] for own in shards for s in own for k in range(len(s) + 1)]
            made = [bwt.Shard(own, depth) for own in shards]
            rows, block, shared = bwt.merge(made, depth)
            firsts = np.cumsum([0, *(len(s.places) for s in made)])
            place = np.concatenate([s.places + at for s, at in zip(made, firsts, strict=False)])
            order = [suffixes[place[r]][:depth] for r in rows]
            counts = Counter(s[:depth] for s in suffixes if len(s) >= depth)
            assert order == sorted(s for s, n in counts.items() for _ in range(n) if n > 1)
            assert all((order[j] == order[j - 1]) == (block[j] == block[j - 1]) for j in range(1, len(order)))
            for r, n in enumerate(shared.tolist()):
                own = suffixes[place[r]]
                most = max(next((k for k, (x, y) in enumerate(zip(own, other, strict=False)) if x != y), min(len(own), len(other))) for q, other in enumerate(suffixes) if q != place[r]) if len(suffixes) > 1 else 0
                assert n == min(most, depth)


def brute_resampled(rows, target, buckets, most, least, percent):
    def features(text):
        ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text))
        return len(ws), [" ".join(ws[i : i + n]) for n in range(1, most + 1) for i in range(len(ws) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s, t = Counter(), Counter()
    for _, text, _ in rows:
        s.update(map(bucket, features(text)[1]))
    for text in target:
        t.update(map(bucket, features(text)[1]))
    n_s, n_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for doc_id, text, _ in rows:
        n_words, fs = features(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * n_s / ((s[b] + 1) * n_t))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n_words])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], -1 if r[0] is None else r[0]))
    ranks = {id(r): i + 1 for i, r in enumerate(able[: percent * len(able) // 100])}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=str)


@pytest.mark.parametrize(("buckets", "most"), [(10_000, 1), (50, 3)])
def test_resampling(spark, rows, buckets, most):
    target = ["alpha beta été", None, "", "psi psi psi Rho 12"]
    got = importance.resample(frame(spark, rows), spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id int, text string"), buckets, most, 5, 40)
    assert sorted(map(tuple, got.collect()), key=str) == brute_resampled(rows, target, buckets, most, 5, 40)


def test_resampling_of_nothing(spark):
    empty = frame(spark, [])
    assert importance.resample(empty, empty).count() == 0
    assert importance.resample(frame(spark, [(1, "a b", None)]), empty, least_words=1, percent=100).first()["rank"] == 1


def test_runs_go_on_over_parts(monkeypatch):
    text = " ".join(f"w{i % 7}" for i in range(300))

    def total():
        trie = importance.WordTrie()
        return Counter(trie.states[n] for block in importance._blocks([text], 3) for nodes, _ in importance._runs(trie, block, 3) for n in nodes.tolist())

    whole = total()
    monkeypatch.setattr(importance, "PART", 40)
    assert total() == whole
