"""Token counts, alignment and the prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from codequarry.llm import alignment, language, packing, prefix_trie, token_counts
from codequarry.llm.vocabulary import ids_of, odd_characters, pre_tokens

DEFINITION = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CLASHES = ["block", "places", "times", "bucket", "keys", "at", "n", "value", "depth", "slot", "digest", "size", "part"]
BOUNDS = [{}, {"block_keys": 40}, {"block_bytes": 1}]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(8)
    words = ["the", "naïve", "straße", "über-", "it's", "x1", "中文", "🙂", "á", "　", "don't", "\t", "\n\n", "  ", "<0x41>", "</s>"]
    found = [None, "", " ", " \t\n  ", "a", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext", "▁a", "\x00b"]
    found += ["a" * 5000, "ab " * 3000, "᳿x", "\U0002ebf0a1 \U000107bb", "é" * 300, "\x85x᠎y​"]
    found += [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 200))) for _ in range(40)]
    return found + [" ".join(rnd.choice(words) for _ in range(30_000)), found[20], found[20]]


@pytest.fixture(scope="module")
def rows(texts):
    return [*enumerate(texts), (3, "another text under a number seen before"), (None, texts[20]), (None, None), (20, texts[20])]


@pytest.fixture(scope="module")
def docs(spark, rows):
    fields = ", ".join(["doc_id long", "text string", *[f"{name} string" for name in CLASHES]])
    return spark.createDataFrame([(i, t, *["x"] * len(CLASHES)) for i, t in rows], fields).repartition(3).cache()


def listed(found):
    return sorted(map(tuple, found), key=repr)


def test_odd_characters_are_those_split_otherwise():
    odd = odd_characters(DEFINITION)
    splitter, plain = Tokenizer.from_file(DEFINITION).pre_tokenizer, pre_tokens(DEFINITION, frozenset())
    for code in [*range(0x250), *range(0x1C80, 0x1D00), *range(0x2E0, 0x3000, 7), *range(0x10780, 0x107C0), *range(0x2EBE0, 0x2EC20)]:
        text = f"a{chr(code)}b !{chr(code)}1{chr(code)} {chr(code)}"
        same = [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)] == list(plain(text))
        assert same == (chr(code) not in odd), hex(code)


@pytest.mark.parametrize("special_as_text", [True, False])
def test_ids_are_those_of_the_library(texts, special_as_text):
    tokenizer = Tokenizer.from_file(DEFINITION)
    tokenizer.encode_special_tokens = special_as_text
    encode = ids_of(DEFINITION, odd_characters(DEFINITION), special_as_text)
    for text in texts:
        assert encode(text or "") == tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("bounds", BOUNDS)
def test_token_counts(docs, rows, bounds):
    tokenizer = Tokenizer.from_file(DEFINITION)
    expected = []
    for doc, text in rows:
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc, len((text or "").encode()), n, n > 100))
    found = token_counts.count_tokens(docs, DEFINITION, limit=100, **bounds)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert listed(found.collect()) == listed(expected)


def test_token_counts_of_nothing(docs):
    assert token_counts.count_tokens(docs.limit(0), DEFINITION).count() == 0
    assert [r.n_tokens for r in token_counts.count_tokens(docs.filter("text = ''"), DEFINITION).collect()] == [0]


def test_each_pre_token_is_asked_for_once_a_block(docs):
    written = token_counts.pre_token_frequencies(docs, DEFINITION, 7).toPandas()
    keys = Counter(key for _, row in written[written["bucket"].notna()].iterrows() for key in [(row["block"], k) for k in row["keys"]])
    assert keys and max(keys.values()) == 1


def spans(tokens):
    ends = np.cumsum([0, *map(len, tokens)]).tolist()
    return list(zip(ends, ends[1:]))


def aligned_one_by_one(rows):
    tokenizer = Tokenizer.from_file(DEFINITION)
    tokenizer.encode_special_tokens = True
    vocabulary = {number: token for token, number in tokenizer.get_vocab().items()}
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in own)}
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    known, counts = [], Counter()
    for doc, text in rows:
        a = tokenizer.encode(f" {text or ''}", add_special_tokens=False).ids
        b = model.encode(text or "")
        a_tokens = [bytes(byte_of[c] for c in vocabulary[i]) for i in a]
        b_tokens = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, model.id_to_piece(b))]
        if not text or not b"".join(a_tokens) == b"".join(b_tokens) == f" {text}".encode():
            known.append((doc, None))
            continue
        a_spans, b_spans = spans(a_tokens), spans(b_tokens)
        links, begin = [], 0
        for i, (start, end) in enumerate(a_spans):
            while b_spans[begin][1] <= start:
                begin += 1
            j = begin
            while j < len(b_spans) and b_spans[j][0] < end:
                links.append((a[i], b[j]))
                j += 1
        cuts = sorted({end for _, end in a_spans} & {end for _, end in b_spans})
        groups = [(",".join(str(i) for i, s in zip(ids, found) if low < s[1] <= high)) for low, high in zip([0, *cuts], cuts) for ids, found in ((a, a_spans), (b, b_spans))] if len(text) < 9_000 else None
        known.append((doc, (len(a), len(b), len(cuts), links, groups)))
        counts.update(links)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    for doc, found in known:
        if found is None:
            yield doc, 0, 0, 0, 0, "", 0, 0
            continue
        n_a, n_b, n_groups, links, groups = found
        written = ";".join("|".join(groups[i : i + 2]) for i in range(0, len(groups), 2)) if groups else None
        highest = sum(counts[pair] == best[pair[1]] for pair in links)
        yield doc, n_a, n_b, n_groups, len(links), written, highest, sum(counts[pair] for pair in links)


@pytest.mark.parametrize("bounds", [{}, {"block_links": 50}])
def test_alignment(docs, rows, bounds):
    expected = list(aligned_one_by_one(rows))
    long = {row[5] for row in expected} & {None}
    found = [tuple(row) for row in alignment.align(docs, DEFINITION, PIECES, keep_groups=True, **bounds).collect()]
    assert long and [row[0] for row in listed(expected)].count(None) == 2
    unwritten = {row[0] for row in expected if row[5] is None}
    drop = lambda row: (*row[:5], None, *row[6:]) if row[0] in unwritten else row
    assert listed(map(drop, found)) == listed(map(drop, expected))
    digested = {row.doc_id: row.groups_sha256 for row in alignment.digests(alignment.align(docs, DEFINITION, PIECES, **bounds)).collect()}
    for row in found:
        if row[0] not in (3, None):
            assert digested[row[0]] == (hashlib.sha256(row[5].encode()).hexdigest() if row[5] else "")


def test_alignment_of_nothing(docs):
    assert alignment.align(docs.limit(0), DEFINITION, PIECES).count() == 0
    found = alignment.align(docs.filter("text is null or text = ''"), DEFINITION, PIECES).collect()
    assert found and all(row.n_links == 0 and row.groups == "" for row in found)


def test_coalescing_random_cuts():
    rnd = random.Random(2)
    for _ in range(200):
        size = rnd.randint(1, 30)
        cuts = [sorted({*rnd.sample(range(1, size + 1), rnd.randint(1, size)), size}) for _ in range(2)]
        a, b = (np.diff([0, *c]) for c in cuts)
        found = alignment.coalesce(a, b)
        both = sorted(set(cuts[0]) & set(cuts[1]))
        assert found.a_group.tolist() == [sum(cut < end for cut in both) for end in cuts[0]]
        assert found.b_group.tolist() == [sum(cut < end for cut in both) for end in cuts[1]]
        pairs = [(i, j) for i, (s, e) in enumerate(zip([0, *cuts[0]], cuts[0])) for j, (t, f) in enumerate(zip([0, *cuts[1]], cuts[1])) if s < f and t < e]
        assert list(zip(found.link_a.tolist(), found.link_b.tolist())) == pairs


def test_perfect_hash():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        keys = np.unique(rng.integers(-50, 50, (n, 3)), axis=0)
        table = prefix_trie.PerfectHash(keys)
        assert sorted(table.slots(keys).tolist()) == list(range(len(keys)))
        others = np.unique(rng.integers(60, 90, (40, 3)), axis=0)
        assert (table.slots(others) == -1).all()
    with pytest.raises(ValueError, match="distinct"):
        prefix_trie.PerfectHash(np.zeros((2, 3), np.int64))


def trie_one_by_one(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in own.items()}
    members, rebuilt = defaultdict(list), {}
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % 9
        rebuilt[conv] = own.get(conv - conv % 5, [])[:h] + own[conv][h:]
        for depth in range(len(rebuilt[conv]) + 1):
            members[tuple(rebuilt[conv][:depth])].append(conv)
    children, leaves, saved = Counter(path[:-1] for path in members if path), Counter(), Counter()
    for path, convs in members.items():
        for depth in range(len(path) + 1):
            saved[path[:depth]] += (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
            leaves[path[:depth]] += not children[path]
    for path, convs in members.items():
        ends = ",".join(str(conv) for conv in convs if len(rebuilt[conv]) == len(path))
        parent = members[path[:-1]][0] if path else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        yield convs[0], len(path), parent, len(convs), children[path], leaves[path], saved[path], sha


@pytest.fixture(scope="module")
def conversations():
    rnd = random.Random(3)
    rows = []
    for conv in range(60):
        for turn in range(rnd.choice([1, 2, 3, 8, 12]) if conv not in (12, 35) else 0 if conv == 12 else 40):
            text = rnd.choice(["x", "yy", "é", None, ""]) if rnd.random() < 0.8 else f"{conv}-{turn}"
            rows.append((conv, turn if rnd.random() < 0.95 else None, rnd.choice(["user", "bot", None]), text))
    long = [row for row in rows if row[0] == 35]
    # Copies of a long conversation that end at different turns, and rows that repeat.
    rows += [(100 + i, *row[1:]) for i in range(9) for row in long[: 30 + i % 3]]
    return [*rows, (None, 0, "user", "z"), rows[3], rows[3], (-4, 1, "user", "x"), (1 << 60, 0, "user", "x")]


@pytest.mark.parametrize("bounds", [{}, {"shard_rows": 40}, {"unit": 3, "shard_rows": 40}, {"unit": 1, "shard_rows": 100}])
def test_prefix_trie(spark, conversations, bounds):
    fields = "conv_id long, turn long, role string, text string, " + ", ".join(f"{name} string" for name in CLASHES)
    table = spark.createDataFrame([(*row, *["x"] * len(CLASHES)) for row in conversations], fields).repartition(4)
    ordered = prefix_trie.in_order(prefix_trie.turns(table))
    found = prefix_trie.digests(prefix_trie.trie(*prefix_trie.forked(ordered), **bounds))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert listed(found.select(*names).collect()) == listed(trie_one_by_one(conversations))


def test_prefix_trie_of_nothing(spark):
    table = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(*prefix_trie.forked(prefix_trie.in_order(prefix_trie.turns(table)))).count() == 0


def test_ends_of_one_node_written_in_parts(spark):
    ends = spark.range(1000).selectExpr("7L as conv_id", "2L as depth", "id * 3 as member").repartition(5)
    found = prefix_trie._end_digests(ends, at_once=64).collect()
    assert [tuple(row) for row in found] == [(7, 2, hashlib.sha256(",".join(str(3 * i) for i in range(1000)).encode()).hexdigest())]


def test_never_more_sequences_than_plain_best_fit():
    rnd = random.Random(12)
    for _ in range(60):
        capacity = rnd.choice([10, 64, 200])
        counts = Counter(min(capacity, 1 + int(rnd.expovariate(rnd.choice([3, 10]) / capacity))) for _ in range(rnd.randint(1, 400)))
        plan = packing.plan_lengths(counts, capacity)
        used = Counter()
        for runs, times in plan:
            assert sum(length * k for length, k in runs) <= capacity
            for length, k in runs:
                used[length] += k * times
        assert used == counts
        rooms: list[int] = []
        for length in sorted(counts.elements(), reverse=True):
            room = min((r for r in rooms if r >= length), default=None)
            if room is not None:
                rooms.remove(room)
            rooms.append((capacity if room is None else room) - length)
        assert sum(times for _, times in plan) <= len(rooms)


def test_texts_without_a_letter_are_undetermined(spark):
    docs = spark.createDataFrame([(0, "the and of", "en"), (2, "der und die", "de"), *[(10 + i, t, "en") for i, t in enumerate(["½ ² ①", "Ⅷ", "١٢", "_", "a½"])]], "doc_id long, text string, lang string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs).collect()}
    assert [found[i] for i in range(10, 14)] == [("und", 0.0)] * 4 and found[14][0] != "und"
