"""Document operators against brute force, over nulls, empty and long texts, repeats and clashing columns."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from codequarry.llm import byte_bpe, class_ngrams, language, packing, secrets, simhash, substring_dedup, suffix_dedup
from codequarry.llm.vocabulary import encoding, read_ranks

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DEFINITION = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
CLASHES = ["score", "found", "mark", "text_hash", "bits", "n_words", "lang_pred", "held_out", "row", "kept", "copies"]


def _edge_texts():
    rnd = random.Random(5)
    words = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 7))) for _ in range(300)]
    passage = " ".join(rnd.choice(words) for _ in range(70))
    texts = [None, "", " \t\n  ", "a", "Ünïcode 中文 🙂 it's <|endoftext|>\x85x 12 3", "a" * 3000, "ab " * 700]
    for _ in range(25):
        own = " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 120)))
        texts.append(own + (" " + passage + " " + rnd.choice(words) if rnd.random() < 0.4 else ""))
    long = [rnd.choice(words) for _ in range(9000)]
    texts += [" ".join(long), "\n".join([*long[:4000], "changed", *long[4001:]]), texts[9], texts[9] + " more", passage]
    return texts


@pytest.fixture(scope="module")
def rows():
    listed = [(i, text) for i, text in enumerate(_edge_texts())]
    return listed + [listed[10], (3, "another text under a number seen before"), (None, listed[11][1]), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    langs = ["en", None, "de"]
    table = [(i, t, langs[n % 3], None if n % 4 else "src", None, *[f"x{n}"] * len(CLASHES)) for n, (i, t) in enumerate(rows)]
    names = ["doc_id long", "text string", "lang string", "source string", "n_chars long", *[f"{c} string" for c in CLASHES]]
    return spark.createDataFrame(table, ", ".join(names)).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _sorted(found):
    return sorted(found, key=repr)


def _sha(data):
    return hashlib.sha256(data).hexdigest()


def test_encoding_and_decoding(docs, rows, empty):
    coder = encoding(RANKS)
    expected = []
    for doc, text in rows:
        ids = coder.encode_ordinary(text or "")
        expected.append((doc, len(ids), _sha(" ".join(map(str, ids)).encode()), _sha((text or "").encode())))
    for chunk, overlap in ((32_768, 512), (200, 40), (64, 2)):
        found = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(docs, RANKS, chunk, overlap), RANKS))
        assert _sorted(map(tuple, found.collect())) == _sorted(expected), (chunk, overlap)
    assert byte_bpe.decode(byte_bpe.encode(empty, RANKS), RANKS).count() == 0


def test_ranks_of_a_definition_are_those_of_the_rank_file():
    assert read_ranks(DEFINITION) == read_ranks(RANKS)


def test_definition_encodes_like_its_own_library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(DEFINITION)
    tokenizer.encode_special_tokens = True
    for text in _edge_texts():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert encoding(DEFINITION).encode_ordinary(text or "") == ids


def test_packing_query_reads_added_tokens_as_the_library_does(spark, tmp_path):
    from tokenizers import Tokenizer

    from codequarry.llm import workload

    texts = [*_edge_texts(), "a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>y  ", "  <|endoftext|>\n", "<|endoftext"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r.doc_id, r.start): (r.length, r.ids_crc32) for r in workload.QUERIES["op2_best_fit_packing"](spark, str(tmp_path)).collect()}
    tokenizer = Tokenizer.from_file(DEFINITION)
    for doc, text in enumerate(texts):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        pieces = sorted(start for number, start in found if number == doc)
        for start, end in zip(pieces, [*pieces[1:], len(ids)]):
            assert found[doc, start] == (end - start, zlib.crc32(np.array(ids[start:end], "<u4").tobytes())), text


@pytest.mark.parametrize("capacity", [16, 2048])
def test_packing_places_every_token_once(docs, rows, empty, capacity):
    found = packing.pack_documents(docs, DEFINITION, capacity, keep_ids=True).collect()
    coder = encoding(DEFINITION)
    expected = []
    for doc, text in rows:
        ids = [*coder.encode_ordinary(text or ""), 0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected.append((doc, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    assert _sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == _sorted(expected)
    filled = defaultdict(list)
    for r in found:
        filled[r.sequence_id].append((r.offset, r.length))
        assert len(r.ids) == r.length
    for parts in filled.values():
        parts.sort()
        ends = [0]
        for offset, length in parts:
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= capacity
    total = sum(length for *_, length, _ in expected)
    assert len(filled) <= math.ceil(total / capacity) * 1.1 + 1
    assert packing.pack_documents(empty, DEFINITION).count() == 0


def test_packed_sequences_hold_their_ids(docs):
    packed = packing.pack_documents(docs, DEFINITION, 64, keep_ids=True)
    lengths = {r.sequence_id: r.n for r in packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()}
    for r in packing.sequences(packed).collect():
        assert len(r.ids) == lengths[r.sequence_id] <= 64


def test_plan_uses_every_length_as_often_as_counted():
    rnd = random.Random(1)
    for _ in range(30):
        capacity = rnd.choice([1, 2, 3, 10, 64])
        counts = {rnd.randint(1, capacity): rnd.randint(1, 50) for _ in range(rnd.randint(0, 20))}
        plan, used = packing.plan_lengths(counts, capacity), Counter()
        for runs, times in plan:
            assert times > 0 and sum(length * k for length, k in runs) <= capacity
            for length, k in runs:
                used[length] += k * times
        assert used == counts


def test_exact_complements_come_first():
    plan = packing.plan_lengths({10: 2, 7: 1, 3: 1, 5: 1, 4: 1, 1: 1}, 10)
    assert sum(times for _, times in plan) == 4


def _base_scores(rows):
    held = {doc: doc is not None and zlib.crc32(str(doc).encode()) % 5 == 1 for doc, _ in rows}
    tokens = [(doc, [w.lower() for w in WORD.findall((text or "").encode())] + [b" "]) for doc, text in rows]
    counts = Counter(w for doc, words in tokens if not held[doc] for w in words)
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc, words in tokens:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in words)
        out.append((doc, held[doc], len(words), sum(counts[w] > 0 for w in words), total, round(base, 6)))
    return out


def test_language_model_scores(docs, rows, empty):
    for bounds in ({}, {"frequent": 40, "core": 10, "classes": 3}):
        found = class_ngrams.score_documents(docs, **bounds).collect()
        base = [(*r[:5], round(r.base_score, 6)) for r in found]
        assert _sorted(base) == _sorted(_base_scores(rows)), bounds
        assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert class_ngrams.score_documents(empty).count() == 0


def test_language_model_without_training_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    (row,) = class_ngrams.score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)


def _trained(rows, spark, **bounds):
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    text = table.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    model, classed = class_ngrams.train(text, class_ngrams.word_counts(text), **bounds)
    contexts = {word: int(model.contexts[i]) for word, i in model.number.items()}
    return model, contexts, {bytes(r.word): (r.n, r["class"]) for r in classed.collect()}


def _after(rows, contexts, classes):
    """By word, how often it comes after each context."""
    seen = defaultdict(Counter)
    for _, text in rows:
        words = [b" ", *[w.lower() for w in WORD.findall((text or "").encode())], b" "]
        for before, word in zip(words, words[1:]):
            seen[word][contexts.get(before, classes)] += 1
    return seen


def _probability(rows, contexts, classed, classes, mixed=0.95):
    """P(word | context) from plain counts of the classes and contexts."""
    seen = _after(rows, contexts, classes)
    moves, sizes = defaultdict(Counter), defaultdict(float, {classes: 0.5})
    for word, counts in seen.items():
        n, kind = classed[word]
        assert n == counts.total() and (kind == classes) == (n == 1)
        sizes[kind] += n + 0.5
        for context, times in counts.items():
            moves[context][kind] += times
    plain = sum(n for n, _ in classed.values()) + 0.5 * (len(classed) + 1)

    def probability(context, word):
        n, kind = classed.get(word, (0, classes))
        step = (moves[context][kind] + 0.5) / (moves[context].total() + 0.5 * len(sizes))
        return mixed * step * (n + 0.5) / sizes[kind] + (1 - mixed) * (n + 0.5) / plain

    return probability


LM_BOUNDS = [{"frequent": 40, "core": 10, "classes": 3}, {"frequent": 200, "core": 60, "classes": 4, "rounds": 2}, {"classes": 5}]


@pytest.mark.parametrize("bounds", LM_BOUNDS)
def test_language_model_scores_are_those_of_plain_counts(spark, rows, bounds):
    training = rows[::2]
    model, contexts, classed = _trained(training, spark, **bounds)
    classes = bounds["classes"]
    probability = _probability(training, contexts, classed, classes)
    # After any context, the probabilities of all known words and of one unknown word sum to one.
    for context in range(classes + 1):
        assert sum(probability(context, word) for word in [*classed, b"never seen"]) == pytest.approx(1.0)
    table = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)], "doc_id long, text string")
    asked = table.select("doc_id", F.lit(False).alias("held_out"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    words = spark.createDataFrame([(w, n, c) for w, (n, c) in classed.items()], "word binary, n long, class int")
    for r in class_ngrams.score(asked, model, words).collect():
        tokens = [b" ", *[w.lower() for w in WORD.findall((rows[r.doc_id][1] or "").encode())], b" "]
        expected = sum(math.log10(probability(contexts.get(a, classes), b)) for a, b in zip(tokens, tokens[1:]))
        assert r.score == pytest.approx(expected, abs=1e-6)


def test_rounds_end_where_no_word_has_a_likelier_class(spark, rows):
    """All words, not only frequent ones, are where the likelihood of what comes after each context is greatest."""
    model, contexts, classed = _trained(rows, spark, frequent=50, core=20, classes=3, rounds=60)
    seen = _after(rows, contexts, 3)
    table = np.zeros((4, 3))
    for word, counts in seen.items():
        for context, n in counts.items():
            if classed[word][1] < 3:
                table[context, classed[word][1]] += n
    evidence = np.log((table + 0.5) / (table + 0.5).sum(axis=0))
    moved = [w for w, c in seen.items() if c.total() > 1 and classed[w][1] != sum(n * evidence[k] for k, n in c.items()).argmax()]
    assert not moved and sum(c < 3 for _, c in classed.values()) > 200


def _likelihood(pairs, member):
    classes = np.eye(3)[member]
    table = classes.T @ pairs @ classes
    x_log_x = lambda x: float((x * np.log(np.maximum(x, 1e-9))).sum())
    return x_log_x(table) - x_log_x(table.sum(axis=0)) - x_log_x(table.sum(axis=1))


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(5)
    true = rng.integers(0, 3, 60)
    moves = np.array([[1, 9, 2], [8, 1, 3], [2, 2, 9]])
    weight = rng.random(60) + 0.2
    pairs = rng.poisson(6 * moves[true[:, None], true[None, :]] * weight[:, None] * weight[None, :]).astype(float)
    member = class_ngrams.exchange(pairs, 3, sweeps=100)
    assert _likelihood(pairs, member) > _likelihood(pairs, np.arange(60) % 3)
    for word in range(60):
        for other in range(3):
            moved = np.where(np.arange(60) == word, other, member)
            assert _likelihood(pairs, moved) <= _likelihood(pairs, member) + 1e-6


def test_contexts_of_a_word_cross_the_shuffle_as_one_row(spark):
    texts = [b"a b a c d", b"b a", b"", b"x a b x", *[b"a b c a"] * 30]
    docs = spark.createDataFrame([(text,) for text in texts], "text binary").repartition(3)
    number, contexts = {b"a": 0, b"b": 1, class_ngrams.END: 2}, np.array([0, 1, 1, 2])
    counts = class_ngrams._context_counts(docs, number, contexts, 3)
    expected = {}
    for text in texts:
        words = class_ngrams.tokens(text)
        for before, word in zip([class_ngrams.END, *words], words):
            expected.setdefault(word, [0, 0, 0])[contexts[number.get(before, 3)]] += 1
    assert {bytes(r.word): [r.s0, r.s1, r.s2] for r in counts.collect()} == expected
    # Not a row for each word and context.
    assert "cells" in counts._jdf.queryExecution().executedPlan().toString()


def test_model_beats_word_frequency_on_held_out_texts(spark):
    from conftest import SF

    docs = spark.read.parquet(SF + "/documents.parquet")
    scored = class_ngrams.score_documents(docs)
    model = {r.held_out: r.perplexity for r in class_ngrams.perplexity(scored).collect()}
    plain = {r.held_out: r.perplexity for r in class_ngrams.perplexity(scored, "base_score").collect()}
    assert model[True] < plain[True]


def _substring_brute(rows, window):
    listed = [(doc, WORD.findall((text or "").encode())) for doc, text in rows]
    least = {}
    for doc, words in listed:
        for i in range(len(words) - window + 1):
            key, number = tuple(words[i : i + window]), math.inf if doc is None else doc
            least[key] = min(least.get(key, math.inf), number)
    out = []
    for doc, words in listed:
        gone, number = [False] * len(words), math.inf if doc is None else doc
        for i in range(len(words) - window + 1):
            if least[tuple(words[i : i + window])] < number:
                gone[i : i + window] = [True] * window
        out.append((doc, len(words), sum(gone), _sha(b" ".join(w for w, g in zip(words, gone) if not g))))
    return out


@pytest.mark.parametrize("window, period", [(50, None), (50, 7), (13, None), (8, 7)])
def test_substring_dedup(docs, rows, empty, window, period):
    found = substring_dedup.digests(substring_dedup.deduplicate(docs, window, period)).collect()
    assert _sorted(map(tuple, found)) == _sorted(_substring_brute(rows, window))
    assert substring_dedup.deduplicate(empty).count() == 0


@pytest.mark.parametrize("period", sorted(substring_dedup.COVERS))
def test_covers_give_every_difference(period):
    cover = substring_dedup.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_substring_dedup_rejects_an_unknown_period(docs):
    with pytest.raises(ValueError):
        substring_dedup.deduplicate(docs, 50, 12)


def _suffix_brute(rows, length):
    texts = [(text or "").encode() for _, text in rows]
    counts = Counter(text[i : i + length] for text in texts for i in range(len(text) - length + 1))
    out = []
    for (doc, _), text in zip(rows, texts):
        gone = [False] * len(text)
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc, len(text), sum(gone), spans, _sha(bytes(b for b, g in zip(text, gone) if not g))))
    return out


@pytest.mark.parametrize("length, crowd", [(200, 20_000), (64, 20_000), (64, 1), (33, 2)])
def test_suffix_dedup(docs, rows, empty, length, crowd):
    found = suffix_dedup.digests(suffix_dedup.deduplicate(docs, length, crowd)).collect()
    assert _sorted(map(tuple, found)) == _sorted(_suffix_brute(rows, length))
    assert suffix_dedup.deduplicate(empty).count() == 0


def test_suffix_orders_find_repeats_with_nul_bytes():
    rnd = random.Random(2)
    for _ in range(40):
        text = bytes(rnd.choice(b"\0\0ab") for _ in range(60))
        length, rows = 8, []
        for t in range(10, 40):
            first, last = rnd.randint(0, 2), rnd.randint(2, 7)
            rows.append((first, last, text[t - last : t + length - first]))
        first, last = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        found = suffix_dedup.repeated_strings(np.zeros(len(rows), np.int64), first, last, [r[2] for r in rows], length)
        strings = defaultdict(set)
        for i, (low, high, data) in enumerate(rows):
            for a in range(low, high + 1):
                strings[a, data[high - a : high - a + length]].add(i)
        expected = {(i, a) for (a, _), owners in strings.items() if len(owners) > 1 for i in owners}
        assert set(zip(found[0].tolist(), found[1].tolist())) == expected


def _fingerprint(text, shingle):
    words = [w.lower() for w in WORD.findall((text or "").encode())]
    if not words:
        return 0
    width = min(shingle, len(words))
    hashes = [xxhash.xxh64(b" ".join(words[i : i + width]), seed=42).intdigest() for i in range(len(words) - width + 1)]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def _linked(prints, numbers, distance):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = defaultdict(lambda: None)
    for i, number in enumerate(numbers):
        known = least[root(i)]
        least[root(i)] = number if known is None else known if number is None else min(known, number)
    return [least[root(i)] for i in range(len(prints))]


@pytest.mark.parametrize("distance, crowd", [(3, 20_000), (3, 1), (0, 20_000), (5, 20_000)])
def test_simhash_components(docs, rows, empty, distance, crowd):
    prints = [_fingerprint(text, 3) for _, text in rows]
    reached = _linked(prints, [doc for doc, _ in rows], distance)
    expected = [(doc, f"{p:016x}", c) for (doc, _), p, c in zip(rows, prints, reached)]
    found = simhash.digests(simhash.components(docs, 3, distance, crowd)).collect()
    assert _sorted(map(tuple, found)) == _sorted(expected)
    assert simhash.components(empty).count() == 0


def test_links_connect_what_distances_connect(spark):
    rnd = random.Random(4)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):
        value = rnd.getrandbits(64)
        for _ in range(rnd.randint(1, 60)):
            for _ in range(rnd.randint(0, 3)):
                value ^= 1 << rnd.randrange(64)
            prints.add(value)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "bits long").repartition(4)
    from codequarry.llm.components import connected_components

    for crowd in (20_000, 5):
        links = simhash.near_links(table, 3, crowd).collect()
        assert len(links) < 40 * len(prints) or crowd == 5
        assert all((((r.a ^ r.b) & ((1 << 64) - 1)).bit_count()) <= 3 for r in links)
        found = {r.node: r.component for r in connected_components(simhash.near_links(table, 3, crowd)).collect()}
        groups = defaultdict(set)
        for value in signed:
            groups[found.get(value, value)].add(value)
        expected = defaultdict(set)
        for value, root in zip(signed, _linked(prints, signed, 3)):
            expected[root].add(value)
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_thresholds_of_least_cost():
    cost, thresholds = simhash.allocate([[1, 5, 100, 100], [10, 11, 12, 13], [9, 90, 900, 9000]], 3)
    options = [(a, b, c) for a in range(-1, 4) for b in range(-1, 4) for c in range(-1, 4) if a + b + c + 3 == 4]
    table = [[1, 5, 100, 100], [10, 11, 12, 13], [9, 90, 900, 9000]]
    best = min(sum(table[i][t] if t >= 0 else 0 for i, t in enumerate(option)) for option in options)
    assert cost == best and sum(t + 1 for t in thresholds) == 4


def test_components_of_a_long_chain(spark):
    from codequarry.llm.components import connected_components

    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)], "a long, b long")
    found = {r.node: r.component for r in connected_components(links).collect()}
    assert found == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert connected_components(links.limit(0)).count() == 0


def test_near_duplicates_leave_one_of_each_group(spark, docs, rows, empty):
    rnd = random.Random(8)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(900)]
    listed = list(rows)
    for number in range(1_000, 1_030):
        base = [rnd.choice(words) for _ in range(300)]
        for copy in range(rnd.randint(1, 4)):
            # Some numbers are null, some name several texts, some rows are repeated.
            listed.append((None if rnd.random() < 0.1 else number + copy // 2, " ".join(base)))
            base[rnd.randrange(300)] = rnd.choice(words)
    listed += listed[-3:] + [(5_000, ""), (5_001, None), (5_002, "long " * 100_000)]
    table = spark.createDataFrame([(i, text, f"row {at}") for at, (i, text) in enumerate(listed)], "doc_id long, text string, component string")
    prints = [_fingerprint(text, 3) for _, text in listed]
    groups = defaultdict(list)
    # The place of a component's first row names it.
    for (number, text), place in zip(listed, _linked(prints, list(range(len(listed))), 3)):
        mark = xxhash.xxh64((text or "").encode(), seed=42).intdigest()
        groups[place].append((number is None, number or 0, mark - (1 << 64) if mark >> 63 else mark, text or ""))
    expected = [(None if null else number, text) for null, number, _, text in map(min, groups.values())]
    kept = simhash.remove_near_duplicates(table)
    assert kept.columns == table.columns
    assert _sorted((r.doc_id, r.text or "") for r in kept.collect()) == _sorted(expected)
    assert len(expected) < len(listed)
    assert simhash.remove_near_duplicates(empty).count() == 0
    assert simhash.remove_near_duplicates(docs).columns == docs.columns


def _languages(spark, extra=()):
    rnd = random.Random(3)
    words = {"en": ["the", "house", "and", "think"], "de": ["das", "haus", "und", "ich"], "fr": ["la", "maison", "et", "où"]}
    rows = []
    for i in range(240):
        lang = sorted(words)[i % 3]
        rows.append((i, " ".join(rnd.choice(words[lang]) for _ in range(12)), lang))
    return spark.createDataFrame(rows + list(extra), "doc_id long, text string, lang string").repartition(3)


def test_language_id(spark, docs, empty):
    extra = [(1000, None, "en"), (1001, "12 34 --", "de"), (1002, "thinking houses", None), (None, "das haus", "de"), (1003, "", "fr")]
    found = language.identify(_languages(spark, extra)).collect()
    predicted = {r.doc_id: (r.lang_pred, r.score) for r in found}
    assert all(predicted[i][0] == sorted(("en", "de", "fr"))[i % 3] for i in range(240))
    assert predicted[1000] == predicted[1001] == predicted[1003] == ("und", 0.0)
    assert predicted[1002][0] == "en" and predicted[None][0] == "de"
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert language.identify(docs).count() == docs.count()
    assert language.identify(empty).count() == 0


def _word_first(rows):
    """Predictions and scores from plain counts: whole words, else the longest n-grams of which any was learned."""
    seen = defaultdict(Counter)
    words = lambda text: re.findall(r"[^\W\d_]+", text.lower())
    grams = lambda word, n: [word] if not n else [f"<{word}>"[i : i + n] for i in range(len(word) + 3 - n)]
    for doc, text, lang in rows:
        if text is not None and lang is not None and (doc is None or zlib.crc32(str(doc).encode()) % 3 != 1):
            for word in words(text):
                for n in range(6):
                    seen[n, lang].update(grams(word, n))
    langs = sorted({lang for _, lang in seen})
    learned = {n: set().union(*(seen[n, lang] for lang in langs)) for n in range(6)}
    size = {(n, lang): seen[n, lang].total() + 0.5 * (len(learned[n]) + 1) for n in range(6) for lang in langs}
    for doc, text, _ in rows:
        if not text or not any(unicodedata.category(c).startswith("L") for c in text):
            yield doc, "und", 0.0
            continue
        sums = dict.fromkeys(langs, 0.0)
        for word in words(text):
            kind = next((n for n in (0, 5, 4, 3, 2, 1) if learned[n].intersection(grams(word, n))), None)
            parts = [gram for gram in grams(word, kind) if gram in learned[kind]] if kind is not None else []
            for lang in langs:
                sums[lang] += sum(math.log((seen[kind, lang][g] + 0.5) / size[kind, lang]) for g in parts) / max(len(parts), 1)
        best = max(sums, key=lambda lang: round(sums[lang], 6))
        yield doc, best, round(1 / sum(math.exp((x - sums[best]) / max(len(words(text)), 1)) for x in sums.values()), 6)


def test_language_id_against_plain_counts(spark, docs):
    from conftest import SF

    table = spark.read.parquet(SF + "/documents.parquet").select("doc_id", "text", "lang")
    for some in (docs.select("doc_id", "text", "lang"), table):
        found = [(r.doc_id, r.lang_pred, round(r.score, 6)) for r in language.identify(some).collect()]
        for got, expected in zip(_sorted(found), _sorted(_word_first([tuple(r) for r in some.collect()])), strict=True):
            assert got[:2] == expected[:2] and got[2] == pytest.approx(expected[2], abs=2e-6)


def test_language_without_labels(spark):
    table = spark.createDataFrame([(0, "the house", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in language.identify(table).collect()] == [("und", 0.0)]


def test_language_is_no_input_of_the_prediction(spark):
    model = language.train(_languages(spark))
    wrong = spark.createDataFrame([(0, "das haus und ich", "en")], "doc_id long, text string, lang string")
    assert language.predict(wrong, model).first().lang_pred == "de"


def test_held_out_languages_of_the_table(spark):
    from conftest import SF

    docs = spark.read.parquet(SF + "/documents.parquet")
    found = language.identify(docs).filter("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in found) >= 0.95 * len(found)


SECRETS = [
    ("PassWord = 'abcdefgh1'", 1, 0, 0),
    ("secret=token:abcdefghij", 0, 0, 0),
    ("api_key: short", 0, 0, 0),
    ("x AKIA0123456789AB y AKIA1 AKIAab", 0, 1, 0),
    ("f" * 31 + " " + "0123456789abcdef" * 2, 0, 0, 1),
    ("token=" + "0" * 40, 1, 0, 1),
    ("ſecret=abcdefghij", 0, 0, 0),
    ("🙂 apikey=abcdefgh🙂", 1, 0, 0),
]


def _base_spans(text):
    found = []
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for m in re.finditer(assign, text or "", re.I | re.A):
        found += [(m.start(), 0, m.end())] * (len(m[2]) >= 8)
    for m in re.finditer(r"AKIA[A-Z0-9]+", text or ""):
        found += [(m.start(), 1, m.end())] * (len(m[0]) >= 16)
    for m in re.finditer(r"[0-9a-f]+", text or ""):
        found += [(m.start(), 2, m.end())] * (len(m[0]) >= 32)
    return sorted(found)


def test_base_secrets(spark, docs, rows, empty):
    for text, *counts in SECRETS:
        spans = secrets.base_spans(text)
        assert [sum(k == kind for _, k, _ in spans) for kind in range(3)] == counts, text
        assert spans == _base_spans(text)
    rnd = random.Random(6)
    pieces = ["password", "TOKEN", "=", ":", " ", '"', "AKIA", "ABCDEFGH1234", "deadbeef" * 5, "x", "secret", "é", "abcdefgh"]
    listed = [(i, "".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 25)))) for i in range(200)]
    table = spark.createDataFrame(listed, "doc_id long, text string")
    written = {r.doc_id: r for r in secrets.scan(table, RANKS).collect()}
    for doc, text in listed:
        base = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in _base_spans(text))
        assert written[doc].base_sha256 == _sha(base.encode())
        spans = [s.split(":") for s in written[doc].spans.split(",") if s]
        assert ",".join(":".join(s) for s in spans if s[0] != "random") == base
    assert secrets.scan(docs, RANKS).count() == len(rows)
    assert secrets.scan(empty, RANKS).count() == 0


def test_random_strings_are_found_and_words_are_not():
    coder = encoding(RANKS)
    for text in ("key zX9kQ2vLr8TpW4mBn7Yc1D ends", "ghp_aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW"):
        assert secrets.all_spans(text, coder, 2.0)[1]
    for text in (
        "internationalizationandlocalization", "keitlichenlichkeitbe", "some_long_function_name_here",
        "550e8400-e29b-41d4-a716-446655440000", "D41D8CD98F00B204E9800998ECF8427E", "12345678901234567890123",
        "path/to/some/directory/with/names", "--------------------------------",
    ):
        assert not secrets.all_spans(text, coder, 2.0)[1], text


def test_random_strings_glued_to_words_are_found():
    coder = encoding(RANKS)
    rnd = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for before in ("database_connection_key=", "session_cookie=", "/path/to/some/directory/", "my_application_value_"):
        for length in (20, 24, 32) * 50:
            key = "".join(rnd.choice(letters) for _ in range(length))
            for text in (f"see {before}{key} there", f"see {before}{key[:9]}/{key[9:]}/index there"):
                assert secrets.all_spans(text, coder, 2.0)[1], text
    assert secrets.all_spans("kJhGfDsAqWeRtYuIoPzXbNvQ", coder, 2.0)[1]
    for text in (
        "database_connection_key=some_readable_value", "getElementsByTagNameAndClassName2", "/Users/shared/Documents/reports/2021",
        "user_identifier=550e8400-e29b-41d4-a716-446655440000/profile", "checksum_of_archive=D41D8CD98F00B204E9800998ECF8427E",
    ):
        assert not secrets.has_random_part(text, coder, 2.0), text


def test_redaction_keeps_everything_else(spark, docs):
    found = secrets.redact(docs, RANKS)
    assert found.columns == docs.columns and found.count() == docs.count()
    table = spark.createDataFrame([(1, "a password=abcdefgh1 b AKIA0123456789AB", "x"), (2, None, None)], "doc_id long, text string, found string")
    assert sorted(map(tuple, secrets.redact(table, RANKS).collect())) == [(1, "a [secret] b [secret]", "x"), (2, None, None)]
