"""Byte-level encoding, the Merkle manifest and the alignment of two tokenizers against plain versions."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetspan.llm import alignment, byte_pairs, merkle

BOTH = pytest.mark.parametrize("table", ["awkward", "documents"])
TRICKY = "'sstmdreevllab 12 \n\t  \r\x85 .,!?é中́😀ß\x1c\x00Ⅷ½ <|endoftext|> </s>"


def sha(raw) -> str:
    return hashlib.sha256(raw if isinstance(raw, bytes) else raw.encode()).hexdigest()


@pytest.fixture
def docs(request, table):
    return request.getfixturevalue(table)


def source(name: str) -> bytes:
    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


# --- Byte-level BPE ---


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, source(byte_pairs.RANKS).splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    return byte_pairs.coder(source(byte_pairs.RANKS))


@BOTH
def test_byte_pairs(docs, library):
    want = Counter()
    for r in docs.collect():
        ids = library.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha((r["text"] or "").encode())] += 1
    assert Counter(tuple(r) for r in byte_pairs.encoding_digests(docs).collect()) == want


def test_byte_pairs_keep_offsets_and_decode(awkward, coder):
    encoded = byte_pairs.encode_documents(awkward)
    texts = Counter((r["doc_id"], r["text"] or "") for r in awkward.collect())
    assert Counter((r["doc_id"], r["text"]) for r in byte_pairs.decode_documents(encoded).collect()) == texts
    for r in encoded.where("n_tokens > 50").collect():
        raw = coder.decode(r["ids"])
        assert len(r["ends"]) == r["n_tokens"] and r["ends"][-1] == len(raw)
        for a, b in ((0, 1), (5, 5), (3, 41), (len(raw) - 2, len(raw)), (0, len(raw))):
            assert coder.span(r["ids"], byte_pairs.np.array(r["ends"]), a, b) == raw[a:b]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(TRICKY), st.characters(codec="utf-8", max_codepoint=0x2FFF)), max_size=60))
def test_slices_of_any_text(library, coder, text):
    text = "".join(c for c in text if byte_pairs.unicodedata.category(c) != "Cn")  # newer code points
    assert coder.encode(text) == library.encode_ordinary(text)
    assert "".join(byte_pairs.slices_of(text, 6)) == text
    assert [i for s in byte_pairs.slices_of(text, 6) for i in coder.slices[s][3]] == library.encode_ordinary(text)


def test_a_long_text_goes_through_in_blocks(library, coder, monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choice(TRICKY) for _ in range(rng.randint(1, 9))) for _ in range(20000)) + " " * 5000 + "x" * 3000
    monkeypatch.setattr(byte_pairs, "BLOCK", 1000)
    assert coder.encode(text) == library.encode_ordinary(text)


def test_merging_alone_and_together_agree(coder):
    rng = random.Random(6)
    words = list({"".join(rng.choice("abcdeéß中 1") for _ in range(rng.randint(1, 14))) for _ in range(2000)})
    assert [r[3] for r in coder._merge_all(words)] == [coder.merged(w.encode()) for w in words]


def test_scan_is_the_automaton_step_by_step():
    table, rng = byte_pairs._functions(), random.Random(7)
    for n in (0, 1, 31, 33, 1000, 5003):
        classes = byte_pairs.np.array([rng.randrange(9) for _ in range(n)], int)
        state, states = 0, []
        for c in classes:
            state = byte_pairs._GOES_ON.get(c, {}).get(state, byte_pairs._BEGINS[c])
            states.append(state)
        assert table.maps[table.scan(table.of_class[classes]), 0].tolist() == states


# --- Merkle manifest ---


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(r, more=0) -> str:
    n = None if r["n_chars"] is None else r["n_chars"] + more
    return sha("".join(map(field, (r["doc_id"], r["source"], r["lang"], n, r["text"]))))


def tree(nodes):
    """Root, and for each leaf its proof: (hashes to the left, to the right) level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for leaf_, i in enumerate(at):
            run = range(i // 2 * 2, min(i // 2 * 2 + 2, len(nodes)))
            proofs[leaf_].append(([nodes[j] for j in run if j < i], [nodes[j] for j in run if j > i]))
        nodes = [sha("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
        at = [i // 2 for i in at]
    return nodes[0], proofs


def manifest_truth(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    subs = [tree([leaf(r) for r in groups[name]]) for name in names]
    root, high = tree([s[0] for s in subs])
    for name, (sub, low), above in zip(names, subs, high, strict=True):
        for r, own in zip(groups[name], low, strict=True):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            acc, proof = leaf(r, int(hit)), own + above
            for left, right in proof:
                acc = sha("".join([*left, acc, *right]))
            yield r["doc_id"], leaf(r), sub, root, sha("".join(h for left, right in proof for h in left + right)), acc, acc == root


@BOTH
def test_manifest(docs):
    assert Counter(tuple(r) for r in merkle.manifest_check(docs).collect()) == Counter(manifest_truth(docs.collect()))


def test_manifest_of_odd_groups(spark):
    langs = [None, "", "a", "B", "é", "zz", "-"]
    rows = [(i, "t" * (i % 5) if i % 4 else None, langs[i % 3] if i < 40 else "big", None if i % 9 == 0 else "s", None if i % 6 == 0 else 2**63 - 1) for i in range(90)]
    rows += [(900 + i, "x", lang, "s", 1) for i, lang in enumerate(langs)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    got = Counter(tuple(r) for r in merkle.manifest_check(df).collect())
    assert got == Counter(manifest_truth(df.collect()))
    altered = {r["doc_id"] for r in merkle.manifest(df).where("altered <> leaf").collect()}
    assert altered == {r[0] for r in rows if r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}


def test_a_changed_row_is_found(documents):
    first = merkle.manifest(documents)
    changed = documents.withColumn("source", merkle.F.when(merkle.F.col("doc_id") == 5, "other").otherwise(merkle.F.col("source")))
    again = merkle.manifest(changed)
    leaves = first.select("doc_id", "leaf").exceptAll(again.select("doc_id", "leaf"))
    assert [r["doc_id"] for r in leaves.collect()] == [5]
    assert first.select("root").distinct().exceptAll(again.select("root").distinct()).count() == 1
    assert first.select("subroot").distinct().exceptAll(again.select("subroot").distinct()).count() == 1


# --- Alignment ---


def alignment_truth(texts):
    first = Tokenizer.from_file(public_tokenizers.path(alignment.TOKENIZER))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.MODEL))
    letters = {c: b for b, c in enumerate(alignment.byte_letters())}

    def piece(i):
        return bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    rows, count = [], Counter()
    for text in texts:
        a, b = first.encode(" " + (text or ""), add_special_tokens=False).ids, second.encode(text or "")
        sides = [[bytes(letters[c] for c in first.id_to_token(i)) for i in a], [piece(i) for i in b]]
        if not text or any(b"".join(s) != b" " + text.encode() for s in sides):
            rows.append(((0, 0, 0, 0), [], ""))
            continue
        ends = [[sum(map(len, s[:n])) for n in range(1, len(s) + 1)] if len(s) < 300 else byte_pairs.np.cumsum([len(t) for t in s]).tolist() for s in sides]
        found, i, k, lines = [], 0, 0, []
        while i < len(a) and k < len(b):
            found.append((a[i], b[k]))
            one, two = ends[0][i], ends[1][k]
            i, k = i + (one <= two), k + (two <= one)
        at = [0, 0]
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = [ends[0].index(end, at[0]) + 1, ends[1].index(end, at[1]) + 1]
            lines.append(",".join(map(str, a[at[0] : to[0]])) + "|" + ",".join(map(str, b[at[1] : to[1]])))
            at = to
        count.update(found)
        rows.append(((len(a), len(b), len(lines), len(found)), found, sha(";".join(lines))))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(*sizes, sum(count[p] == most[p[1]] for p in found), sum(count[p] for p in found), digest) for sizes, found, digest in rows]


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 1])
@BOTH
def test_alignment(docs, block_bytes):
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r["doc_id"], *t) for r, t in zip(rows, alignment_truth([r["text"] for r in rows]), strict=True))
    assert Counter(tuple(r) for r in alignment.alignments(docs, block_bytes=block_bytes).collect()) == want


def test_links_are_all_overlaps():
    rng = random.Random(9)
    for _ in range(50):
        sides = [sorted({40, *rng.sample(range(1, 40), rng.randint(0, 20))}) for _ in range(2)]
        start = [[0, *s[:-1]] for s in sides]
        want = [(i, k) for i in range(len(sides[0])) for k in range(len(sides[1])) if max(start[0][i], start[1][k]) < min(sides[0][i], sides[1][k])]
        _, first, second = alignment.links(*map(byte_pairs.np.array, sides))
        assert list(zip(first.tolist(), second.tolist(), strict=True)) == want


def test_parts_of_tricky_texts(spark):
    rng = random.Random(10)
    texts = ["".join(rng.choice(TRICKY) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["▁ab c", "a ▁ b", "<|endoftext|> x <s> </s> <0x41>", " lead", "trail ", "  two  ", "a ▁ b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {(i, *t) for i, t in enumerate(alignment_truth(texts))}
    assert {tuple(r) for r in alignment.alignments(df).collect()} == want


def test_packed_links_come_back():
    for numbers in ([], [0], [5, 6, 900000, 2**31 - 1]):
        packed = alignment.pack(byte_pairs.np.array(numbers, byte_pairs.np.int64), byte_pairs.np.array([n % 7 + 1 for n in numbers], byte_pairs.np.int64))
        assert [x.tolist() for x in alignment.unpack(packed)] == [numbers, [n % 7 + 1 for n in numbers]]


def test_empty_tables_of_the_new_operators(nothing):
    for operator in (byte_pairs.encoding_digests, byte_pairs.encode_documents, merkle.manifest_check, alignment.alignments):
        assert operator(nothing).count() == 0
