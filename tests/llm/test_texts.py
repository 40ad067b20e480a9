"""Operators on texts against brute force, on awkward rows and on whole test tables."""

import hashlib
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from llm_fixtures import long_text
from fleetspan.llm import encoding, licenses, minhash, mixing, quality, sharding, substring, token_counts
from fleetspan.llm.graph import components
from fleetspan.llm.prefixes import Prefixes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BOTH = pytest.mark.parametrize("table", ["awkward", "documents"])


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


@pytest.fixture
def docs(request, table):
    return request.getfixturevalue(table)


def cut(texts, window):
    words = [WORD.findall(t or "") for t in texts]
    count = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    result = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        result.append((w, [x for i, x in enumerate(w) if i not in gone]))
    return result


@BOTH
@pytest.mark.parametrize("window", [35, 12])
def test_substring_dedup(docs, window):
    rows = rows_of(docs)
    want = Counter((i, len(w), len(w) - len(k), sha(" ".join(k))) for (i, _), (w, k) in zip(rows, cut([t for _, t in rows], window), strict=True))
    assert Counter(tuple(r) for r in substring.substring_dedup(docs, window=window).collect()) == want
    if window == 35:
        got = Counter((r["doc_id"], " ".join(WORD.findall(r["text"] or ""))) for r in substring.without_repeats(docs).collect())
        assert got == Counter((i, " ".join(k)) for (i, _), (_, k) in zip(rows, cut([t for _, t in rows], window), strict=True))


def test_substring_dedup_of_a_line_repeated_inside_documents(spark):
    line = " ".join(f"w{i}" for i in range(12))
    own = [" ".join(f"d{d}x{i}" for i in range(50)) for d in range(4)]
    texts = [f"{own[0]} {' '.join([line] * 40)} end", " ".join([line] * 9), f"{line} {own[1]} {line}", f"{own[2]} {line} {line} {own[3]}", own[3]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[1]])] + [(1, texts[1])], "doc_id long, text string")
    rows = rows_of(docs)
    want = Counter((i, len(w), len(w) - len(k), sha(" ".join(k))) for (i, _), (w, k) in zip(rows, cut([t for _, t in rows], 35), strict=True))
    assert Counter(tuple(r) for r in substring.substring_dedup(docs).collect()) == want


@BOTH
def test_token_counts(docs):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    rows = rows_of(docs)
    want = Counter((i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in rows)
    got = token_counts.token_counts(docs).collect()
    assert Counter(tuple(r)[:4] for r in got) == want
    texts = defaultdict(list)
    for i, t in rows:
        texts[i, len((t or "").encode())].append(t or "")
    for r in got:
        text, cut = texts[r["doc_id"], r["n_bytes"]][0], r["fit_chars"]
        if not r["over_limit"]:
            assert cut == len(text)
        elif len(texts[r["doc_id"], r["n_bytes"]]) == 1:
            assert len(model.encode(text[:cut])) <= 4096 < min(len(model.encode(text[:p])) for p in range(cut + 1, cut + 20))


@pytest.mark.parametrize("limit", [0, 1, 7, 20])
def test_longest_prefix_within_a_budget(awkward, limit):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    short = awkward.where("length(text) < 700 or text is null")
    want = Counter((i, max(p for p in range(len(t or "") + 1) if len(model.encode((t or "")[:p])) <= limit)) for i, t in rows_of(short))
    assert Counter((r["doc_id"], r["fit_chars"]) for r in token_counts.token_counts(short, limit=limit).collect()) == want


def test_count_at_every_prefix(awkward):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    short = awkward.where("length(text) < 700 or text is null")
    texts = dict(rows_of(short.where("doc_id not in (4, 9)")))
    for r in token_counts.prefix_counts(short, budget=20).where("doc_id not in (4, 9)").collect():
        text = texts[r["doc_id"]] or ""
        want = [len(model.encode(text[:p])) for p in range(len(text) + 1)]
        assert r["counts"] == want
        assert r["fit_chars"] == max(p for p, n in enumerate(want) if n <= 20)


@BOTH
def test_encoding(docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(public_tokenizers.path(encoding.TOKENIZER))
    want, ids_of = Counter(), Counter()
    for i, t in rows_of(docs):
        ids = own.encode(t or "", add_special_tokens=False).ids
        ids_of[i, tuple(ids)] += 1
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(own.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(tuple(r) for r in encoding.encoding_digests(docs).collect()) == want
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoding.encode_documents(docs).collect()) == ids_of


def test_transducer_streams():
    coder = encoding.Transducer(token_counts.model_bytes(None, encoding.TOKENIZER))
    text = "It's " + "abcdefghij" * 400 + " été Words 123, " * 50
    ids = coder.encode(text)
    assert list(coder.stream(text[i : i + 7] for i in range(0, len(text), 7))) == ids
    plain = "".join(coder.text_stream(ids))
    assert re.sub(r"\s", "", plain) == re.sub(r"\s", "", unicodedata.normalize("NFC", text).lower())
    assert coder.lookahead >= coder.table.longest


def test_tokens_are_emitted_at_the_lookahead(monkeypatch):
    coder = encoding.Transducer(token_counts.model_bytes(None, encoding.TOKENIZER))
    rng = np.random.default_rng(2)
    taken = []
    monkeypatch.setattr(coder.table, "steps", lambda s, f=coder.table.steps: (taken.append(1) or x for x in f(s)))
    for letters in ("ab", "thera", "abcdefghijklmnopqrstuvwxyz"):
        word = "".join(rng.choice(list(letters), 3000))
        taken.clear()
        tokens, ahead = [], []
        for token in coder.word(word):
            tokens.append(token)
            ahead.append(len(taken) - sum(map(len, tokens)) + len(token))
        assert tokens == coder.table.merged(word)
        assert max(ahead) <= coder.lookahead + 4 * coder.table.longest and len(taken) == len(word)


def test_prefix_table_is_the_merge_list():
    ranks = {("a", "b"): 0, ("b", "c"): 1, ("ab", "c"): 2, ("c", "a"): 3, ("bc", "a"): 4}
    table = Prefixes({"a", "b", "c", "ab", "bc", "abc", "ca", "bca"}, lambda a, b: ranks.get((a, b)))
    import itertools

    for n in range(1, 8):
        for word in itertools.product("abc", repeat=n):
            assert table.tokens("".join(word)) == table.merged(word)


def shingles(text, k):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_truth(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    where = defaultdict(list)
    for n, s in enumerate(sets):
        for x in s:
            where[x].append(n)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    shared = Counter((a, b) for ns in where.values() for i, a in enumerate(ns) for b in ns[i + 1 :])
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    low = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        if i is not None:
            low[root(n)].append(i)
    result = Counter()
    for n, (i, _) in enumerate(rows):
        c = min(low[root(n)], default=None) if sets[n] else i
        result[i, len(sets[n]), c, i == c] += 1
    return result


@BOTH
@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates(docs, k):
    assert Counter(tuple(r) for r in minhash.near_duplicates(docs, k=k).collect()) == near_truth(rows_of(docs), k)


def test_one_of_each(awkward):
    kept = [(r["doc_id"], r["text"]) for r in minhash.one_of_each(awkward).collect()]
    ids = Counter(i for i, _ in kept)
    assert ids[8] == 1 and ids[9] == ids[10] == 0 and ids[1] == ids[2] == ids[3] == 1 and ids[None] == 1 and ids[14] == 1 and ids[15] == 0


def test_one_of_each_where_components_share_an_id(spark, awkward):
    kept = [(r["doc_id"], r["text"]) for r in minhash.one_of_each(awkward).collect()]
    assert {t for i, t in kept if i == 4} == {"one", "another text with the same id"}
    a, b = long_text(21, 60), long_text(22, 60)
    df = spark.createDataFrame([(1, a), (1, b), (2, a), (2, b), (None, b), (None, "c"), (None, "d d")], "doc_id long, text string")
    assert Counter((r["doc_id"], r["text"]) for r in minhash.one_of_each(df).collect()) == Counter([(1, a), (1, b), (None, "c"), (None, "d d")])


def test_candidates_that_stars_miss(spark):
    """A chain in one band whose ends are apart is still one component."""
    base = [f"w{i}" for i in range(400)]
    texts = [" ".join(f"c{j}" if j < 9 * i else w for j, w in enumerate(base)) for i in range(12)]
    df = spark.createDataFrame([(100 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert Counter(tuple(r) for r in minhash.near_duplicates(df).collect()) == near_truth(rows_of(df), 5)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 160)) and got[300] == got[200] == 200
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@BOTH
def test_mixing(docs):
    got = mixing.mixed_sources(docs).collect()
    want = Counter((i, len(WORD.findall(t or ""))) for i, t in rows_of(docs))
    assert Counter((r["doc_id"], r["size"]) for r in got) == want
    source = {(r["doc_id"], r["source"]) for r in docs.select("doc_id", "source").collect()}
    sizes, order = Counter(), sorted({s for _, s in source}, key=lambda s: (s is None, (s or "").encode()))
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    weight = {s: (5, 2, 1)[n % 3] for n, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(sizes.values()))
    while True:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 3 * sizes[s]}
        if not over:
            break
        target |= {s: 3.0 * sizes[s] for s in over}
        left -= sum(3 * sizes[s] for s in over)
        open_ -= over
    target |= {s: unit * weight[s] for s in open_}
    by_size = {sizes[s]: target[s] for s in order}
    taken = Counter()
    for r in got:
        assert abs(r["target"] - by_size[r["source_size"]]) < 1e-6 * max(1, r["target"]) or len(set(sizes.values())) < len(sizes)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source_size"], r["target"]] += r["taken"]
    for (_, t), n in taken.items():
        assert abs(n - t) <= 1
    assert Counter(tuple(r) for r in mixing.mixed_sources(docs.repartition(5)).collect()) == Counter(tuple(r) for r in got)
    words = sum(len(WORD.findall(r["text"] or "")) for r in mixing.mixture(docs).collect())
    assert words == sum(r["taken"] for r in got)


def test_mixing_sorts_few_rows_where_weights_are_low(spark, monkeypatch):
    """Texts of digits have the lowest weight, so 0.435 of the keys fall into the last of the first ranges."""
    df = spark.range(8000).selectExpr("id as doc_id", "repeat('12 34 ', 1 + cast(id % 3 as int)) as text", "if(id % 2 = 0, 'a', 'b') as source")
    sorted_, cut_ = [], mixing._last_ranges
    monkeypatch.setattr(mixing, "_last_ranges", lambda *a: sorted_.append(cut_(*a)) or sorted_[-1])
    got = mixing.mixed_sources(df, weights=(2, 1)).collect()
    assert max(r["n"] for r in sorted_[0].collect()) <= mixing.FEW
    keys = {r["doc_id"]: (r["source"], r["key"], r["size"]) for r in mixing.measured(df, "doc_id", "text", "source").collect()}
    taken = {r["doc_id"]: r["taken"] for r in got}
    for source, share in (("a", 2 / 3), ("b", 1 / 3)):
        rows = sorted((k, i, n) for i, (s, k, n) in keys.items() if s == source)
        whole = sum(n for *_, n in rows)
        turns, rest = divmod(int(share * sum(n for *_, n in keys.values()) + 1e-6), whole)
        for _, i, n in rows:
            assert taken[i] == turns * n + min(n, rest)
            rest -= min(n, rest)


@BOTH
def test_mixture_of_whole_documents(docs):
    plan, took = Counter(), Counter()
    for r in mixing.mixed_sources(docs).collect():
        whole, rest = divmod(r["taken"], r["size"]) if r["size"] else (1, 0)
        plan[r["doc_id"], r["size"]] += whole + (rest > 0 and 2 * rest >= r["size"])
    texts = set(rows_of(docs))
    for r in mixing.mixture(docs, whole=True).collect():
        assert (r["doc_id"], r["text"]) in texts
        took[r["doc_id"], len(WORD.findall(r["text"] or ""))] += 1
    assert took == +plan
    empty = Counter((i, t) for i, t in rows_of(docs) if not WORD.findall(t or ""))
    for whole in (True, False):
        assert Counter((i, t) for i, t in rows_of(mixing.mixture(docs, whole=whole)) if not WORD.findall(t or "")) == empty


@BOTH
def test_shards(docs):
    got = sharding.balanced_shards(docs).collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows_of(docs))
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    slots, sizes, homes = defaultdict(list), Counter(), defaultdict(set)
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < 8
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        homes[r["text_crc32"], r["size"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    if len(got) >= 500:
        assert max(sizes.values()) - min(sizes.values()) <= 0.04 * sum(sizes.values()) / 8 + 2 * max(r["size"] for r in got)
        assert all(len(s) == 1 for s in homes.values())


def plain_shards(rows, shards, light, sides):
    """The k-d tree in memory: rows are (key, size, crc, coordinates as shares); sides(node, leaves) gives a row's place by id."""
    def split(part, leaves, first):
        if leaves == 1:
            return {key: first for key, *_ in part}
        if not part:
            return {}
        width = [max(r[3][d] for r in part) - min(r[3][d] for r in part) for d in range(3)]
        d = width.index(max(width))
        place = {r[0]: int(np.floor(r[3][d] * (1 << 20))) * (1 << 32) + r[2] for r in part}
        wanted, before = max(1, round(sum(r[1] for r in part) * (leaves // 2) / leaves)), 0
        for at in sorted(set(place.values())):
            there = sum(r[1] for r in part if place[r[0]] == at)
            if before + there >= wanted:
                break
            before += there
        share = (wanted - before) / there
        share = share if there > light else float(round(share))
        left = [r for r in part if place[r[0]] < at or (place[r[0]] == at and sides[first, leaves, r[0]] < share)]
        kept = {r[0] for r in left}
        right = [r for r in part if r[0] not in kept]
        return split(left, leaves // 2, first) | split(right, leaves - leaves // 2, first + leaves // 2)

    return split(rows, shards, 0)


@pytest.mark.parametrize("shards", [8, 5])
def test_shards_equal_a_split_in_memory(documents, spark, shards):
    measured = sharding._measured(documents, "doc_id", "text").collect()
    low = [min(r[d] for r in measured) for d in sharding.DIMENSIONS]
    wide = [max(r[d] for r in measured) - a for d, a in zip(sharding.DIMENSIONS, low, strict=True)]
    rows = [(r["doc_id"], r["size"], r["text_crc32"], [(r[d] - a) / (w or 1.0) for d, a, w in zip(sharding.DIMENSIONS, low, wide, strict=True)]) for r in measured]
    nodes = spark.createDataFrame([(first, leaves) for leaves in range(2, shards + 1) for first in range(shards)], "first int, leaves int")
    hashed = nodes.join(documents.select("doc_id")).selectExpr("first", "leaves", "doc_id", "pmod(xxhash64(first, leaves, doc_id), 1 << 30) / double(1 << 30) AS side")
    sides = {(r["first"], r["leaves"], r["doc_id"]): r["side"] for r in hashed.collect()}
    want = plain_shards(rows, shards, sum(r[1] for r in rows) / shards / 100, sides)
    assert {r["doc_id"]: r["shard"] for r in sharding.balanced_shards(documents, shards).collect()} == want


def test_a_hot_text_is_spread_over_shards(spark):
    df = spark.range(4000).selectExpr("id as doc_id", "if(id % 2 = 0, repeat('same text ', 20), concat(repeat('own text', 25), id)) as text")
    sizes = Counter()
    for r in sharding.balanced_shards(df).collect():
        sizes[r["shard"]] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) < 1.15 * min(sizes.values())


def test_quality(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    got = quality.quality_scores(documents, labels).collect()
    known = {r["doc_id"]: r["quality"] for r in labels.collect()}
    unseen = [(known[r["doc_id"]], r["predicted"]) for r in got if r["held_out"] and r["doc_id"] in known]
    assert np.mean([a == b for a, b in unseen]) > 0.95
    assert all((zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) == r["held_out"] and 0 <= r["score"] <= 1 for r in got)
    kept = quality.good_documents(documents, labels)
    assert kept.columns == documents.columns and kept.count() == sum(r["predicted"] for r in got)


def plain_features(passage: list[bytes], earlier: list[bytes]) -> dict[str, float]:
    """Some figures of a passage, word by word; ``earlier``: the text's words before it."""
    size, n = sum(map(len, passage)), len(passage)
    kind = lambda codes: sum(b in codes for w in passage for b in w) / size
    lower = [w.lower() for w in earlier + passage]
    at = range(len(earlier), len(lower))
    return {
        **{name: kind(set(codes)) for name, codes in quality._KINDS.items()},
        "length": size / n / 10,
        "spread": max(0.0, sum(len(w) ** 2 for w in passage) / n - (size / n) ** 2) ** 0.5 / 10,
        "longest": np.log1p(max(map(len, passage))) / 5,
        "words": n / quality.PASSAGE,
        "capital": sum(w[:1].isupper() for w in passage) / n,
        "variety": len(set(lower[len(earlier) :])) / n,
        "next": sum(i > 0 and lower[i] == lower[i - 1] for i in at) / n,
    }


def test_passages_and_scores_equal_plain_loops(documents, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir.replace('sf0.001', 'sf0.01')}/labels.parquet")
    model = quality.train(documents.select("doc_id", "text"), labels.select("doc_id", quality.F.col("quality").alias("label")))
    got = {r["doc_id"]: r["score"] for r in quality.quality_scores(documents, labels).collect()}
    p, at = model.parts, {name: i for i, name in enumerate(quality.FEATURES)}
    for r in documents.orderBy("doc_id").limit(150).collect():
        text = r["text"] or ""
        words = [w.encode() for w in WORD.findall(text)]
        bag = [words[i : i + quality.PASSAGE] for i in range(0, max(1, len(words)), quality.PASSAGE)]
        x, bounds = quality.passage_features(quality.pa.array([text]))
        assert bounds.tolist() == [0, len(bag)]
        for i, passage in enumerate(bag):
            for name, value in (plain_features(passage, words[: i * quality.PASSAGE]) if passage else {"empty": 1.0}).items():
                assert x[i, at[name]] == pytest.approx(value, abs=1e-9), name
        mixture, total = np.zeros(len(p["encode_0"])), 0.0
        for row in (x - model.shift) / model.scale:
            h = np.tanh(row @ p["encode"] + p["encode_0"])
            weight = np.exp(np.sum(p["attend"] * np.tanh(h @ p["tanh"]) / (1 + np.exp(-(h @ p["sigmoid"])))))
            mixture, total = mixture + weight * h, total + weight
        assert got[r["doc_id"]] == pytest.approx(1 / (1 + np.exp(-(mixture / total @ p["score"] + p["score_0"]))), abs=1e-9)


def test_attention_gradient_learns_one_bad_passage():
    rng = np.random.default_rng(1)
    bags = [rng.normal(size=(rng.integers(1, 6), len(quality.FEATURES))) for _ in range(400)]
    label = rng.integers(0, 2, 400).astype(float)
    for b, y in zip(bags, label, strict=True):
        b[0, 0] = 6.0 if y == 0 else b[0, 0]
    first = np.append(0, np.cumsum([len(b) for b in bags]))
    model = quality.AttentionModel.fit(np.concatenate(bags), first, label)
    assert ((model.scores(np.concatenate(bags), first) > 0.5) == label).mean() > 0.95


def license_truth(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for p, label in licenses.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    at = [i for i, _ in places]
    keys = {label for label, _, key in licenses.TEMPLATES for i in range(len(words)) if words[i : i + len(key.split())] == key.split()}
    own = {label for _, label in places}
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)), ",".join(sorted(own | keys))


@BOTH
def test_licenses(docs):
    got = licenses.license_scan(docs).collect()
    assert Counter((r["doc_id"], *r[1:7]) for r in got) == Counter((i, *license_truth(t)) for i, t in rows_of(docs))
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == (r["labels"] != "") for r in got)


def test_license_texts_are_found_whole_and_changed(spark):
    own = {label: (text, key) for label, text, key in licenses.TEMPLATES if len(text.split()) > 25}
    rows = [(i, f"Copyright (c) 2024. {text.capitalize()}.") for i, (text, _) in enumerate(own.values())]
    rows += [(100 + i, text.replace("software", "program")) for i, (text, _) in enumerate(own.values())]
    rows += [(200 + i, " ".join(w for n, w in enumerate(text.split()) if key not in text or n % 2)) for i, (text, key) in enumerate(own.values())]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, (label, (_, key)) in enumerate(own.items()):
        assert label in got[i]["labels"].split(",") and got[i]["score"] > 0.999
        assert label in got[100 + i]["labels"].split(",") or "software" in key
        assert label not in got[200 + i]["labels"].split(",")
    changed = [got[100 + i]["score"] for i, label in enumerate(own) if label in ("mit", "isc", "zlib", "bsd")]
    assert len(changed) == 4 and all(0 < score < 1 for score in changed)  # the others hold a short template whole


def test_index_words_agree_on_the_place():
    index = licenses.Index({"cc": 5, "by": 900}, 1000)
    assert [w for w, _ in index.rarest[list(licenses.BASE_PHRASES).index("cc by")]] == ["cc", "by"]
    words = licenses.words_of(licenses.pa.array(["by cc by x cc", "cc", "by cc y by", "cc by"]), licenses.BETWEEN, lower=True)
    template, place, score = index.candidates(words)
    assert place.tolist() == [1, 10] and set(template.tolist()) == {0} and score.tolist() == [1.0, 1.0]


def test_empty_tables(nothing, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int")
    frames = [substring.substring_dedup(nothing), substring.without_repeats(nothing), token_counts.token_counts(nothing), mixing.mixed_sources(nothing), mixing.mixture(nothing), sharding.balanced_shards(nothing), minhash.near_duplicates(nothing), minhash.one_of_each(nothing), quality.quality_scores(nothing, labels), quality.good_documents(nothing, labels), encoding.encoding_digests(nothing), licenses.license_scan(nothing)]
    assert [df.count() for df in frames] == [0] * len(frames)


def test_awkward_quality(awkward, spark):
    labels = spark.createDataFrame([(1, None), (2, 1), (None, 0), (8, 1), (11, 0), (11, 1), (4, 0), (4, 0), (12, 1)], "doc_id long, quality int")
    got = quality.quality_scores(awkward, labels).collect()
    assert len(got) == awkward.count() and all(0 <= r["score"] <= 1 for r in got)
