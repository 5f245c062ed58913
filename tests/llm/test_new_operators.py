"""Packing, token links and turn repair against brute force and the tokenizer libraries."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import epsilon_join, packing, token_links, turns
from tessera.llm.queries import QUERIES
from tessera.llm.ship import ship

SMALL = "/root/testdata/sf0.001"
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
# Bits of text that the tokenizers treat in ways of their own.
BITS = ["a", "b", "The", "word", "é", "ü", "文", "字", "🎉", "ｆ", " ", "  ", "\n", "\r", "\r\n", "\t", "　", "\xa0", "\x1c", "▁", ".", ";", "'s", "<s>", "<|endoftext|>", "<0x41>", "12", "\x00", "\x85", "́", "//"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def pack_one_by_one(lengths, capacity):
    """Best-two-fit without counts: every piece by itself."""
    left, out = sorted(lengths, reverse=True), []
    while left:
        own, gap, rest = [], capacity, []
        for x in left:
            (own if x <= gap else rest).append(x)
            gap -= x if x <= gap else 0
        if gap and len(own) > 1:
            pairs = [(a + b, a, b) for i, a in enumerate(rest) for b in rest[i + 1 :] if a + b <= gap + own[-1]]
            best = max(pairs, default=(0, 0, 0))
            if best[0] > own[-1]:
                rest.append(own.pop())
                for x in best[1:]:
                    own.append(x)
                    rest.remove(x)
        out.append(tuple(sorted(own, reverse=True)))
        left = sorted(rest, reverse=True)
    return sorted(out)


def test_best_two_fit_equals_packing_one_by_one():
    rng = random.Random(1)
    for trial in range(300):
        capacity = rng.choice([5, 10, 17, 40, 100])
        choices = [1, capacity // 2 + 1, capacity // 3 + 1, capacity] if trial % 3 == 0 else range(1, capacity + 1)
        lengths = [rng.choice(choices) for _ in range(rng.randrange(60))]
        bins = packing.best_two_fit(np.bincount(lengths, minlength=capacity + 1).astype(int), capacity)
        got = [tuple(x for x, n in content for _ in range(n)) for times, content in bins for _ in range(times)]
        assert sorted(got) == pack_one_by_one(lengths, capacity)


def test_best_two_fit_depends_on_lengths_not_on_pieces():
    counts = np.random.default_rng(1).integers(0, 10**9, 257)
    counts[0] = 0
    bins = packing.best_two_fit(counts, 256)
    used = Counter()
    for times, content in bins:
        assert sum(length * n for length, n in content) <= 256
        for length, n in content:
            used[length] += times * n
    assert [used[i] for i in range(257)] == counts.tolist()
    assert len(bins) < 2000


def check_packing(got, texts, capacity):
    tokenizer = Tokenizer.from_file(WORDS)
    expected = Counter()
    for doc_id, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, start in enumerate(range(0, len(ids), capacity)):
            own = ids[start : start + capacity]
            expected[doc_id, piece, start, len(own), zlib.crc32(np.array(own, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    filled = defaultdict(list)
    for r in got:
        filled[r.sequence_id].append((r.offset, r.length))
    for own in filled.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= capacity
    return len(filled)


def test_packing_query(spark):
    got = QUERIES["op11_best_two_fit"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    used = check_packing(got, [(r.doc_id, r.text) for r in docs], 4096)
    counts = np.bincount([r.length for r in got], minlength=4097)
    assert used == packing.least_sequences(counts, 4096)


def test_packing_awkward_rows_and_sequences(spark, tmp_path):
    texts = [(1, None), (1, None), (None, "a b"), (3, ""), (3, "x"), (4, "word " * 100), (5, "\x1cA\ny " * 30), (6, " \n ")] + [(7, "hot")] * 200
    docs = spark.createDataFrame([(d, t, 1, 2) for d, t in texts], "doc_id bigint, text string, length int, part int").repartition(5)
    packed = packing.pack(docs, str(tmp_path / "a"), WORDS, capacity=16, end_id=1)
    check_packing(packed.collect(), texts, 16)
    whole = packing.sequences(packed).collect()
    assert all(r.length * 4 == len(r.ids) <= 64 for r in whole)
    assert sum(r.length for r in whole) == sum(r.length for r in packed.collect())
    assert packing.pack(docs.limit(0), str(tmp_path / "b"), WORDS, 16, 1).count() == 0


def link_one_by_one(docs):
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    characters = token_links.byte_characters()
    a_bytes = {i: bytes(characters[c] for c in t) for t, i in json.load(open(BYTES))["model"]["vocab"].items()}
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())]
    found, held = [], Counter()
    for doc_id, text in docs:
        ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)] if text else [[], []]
        spelled = [b"".join(table[i] for i in own) for table, own in zip((a_bytes, b_bytes), ids)]
        links, groups = Counter(), []
        if not text or spelled != [(" " + text).encode()] * 2:
            found.append((doc_id, [], [], groups, links))
            continue
        ends = [np.cumsum([len(table[i]) for i in own]).tolist() for table, own in zip((a_bytes, b_bytes), ids)]
        last = [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            upto = [e.index(cut) + 1 for e in ends]
            own = [x[i:j] for x, i, j in zip(ids, last, upto)]
            groups.append("|".join(",".join(map(str, x)) for x in own))
            links.update((x, y) for x in own[0] for y in own[1])
            last = upto
        held.update(links.keys())
        found.append((doc_id, *ids, groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for doc_id, own_a, own_b, groups, links in found:
        best = sum(n for (x, y), n in links.items() if held[x, y] == most[x])
        total = sum(n * held[pair] for pair, n in links.items())
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((doc_id, len(own_a), len(own_b), len(groups), sum(links.values()), best, total, digest))
    return sorted(out, key=repr)


LINKED = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def test_link_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    assert rows(QUERIES["op12_token_links"](spark, SMALL), *LINKED, "groups_sha256") == link_one_by_one(docs)


def test_links_of_odd_texts(spark, tmp_path):
    rng = random.Random(3)
    docs = [(i, "".join(rng.choice(BITS[:19] + BITS[20:] if i % 8 else BITS) for _ in range(rng.randrange(25)))) for i in range(1500)]
    docs += [(None, None), (None, ""), (7, "x"), (7, "x"), (9, "word " * 5000)]
    df = spark.createDataFrame([(d, t, 5, "p") for d, t in docs], "doc_id bigint, text string, piece int, pairs string").repartition(3)
    got = token_links.align(df, str(tmp_path / "a"), BYTES, PIECES, keep_groups=False)
    assert rows(got, *LINKED, "groups") == link_one_by_one(docs)
    assert token_links.align(df.limit(0), str(tmp_path / "b"), BYTES, PIECES).count() == 0


def test_row_products_and_overlaps():
    rng = np.random.default_rng(5)
    left, right = rng.integers(0, 3, (6, 8)), rng.integers(0, 3, (8, 5))

    def sparse(m):
        row, column = np.nonzero(m)
        return token_links.Csr(np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(m)))]), column, m[row, column], m.shape[1])

    product = token_links.row_products(sparse(left), sparse(right))
    dense = np.zeros((6, 5), dtype=int)
    dense[product.row_of_entry(), product.columns] = product.values
    assert (dense == left @ right).all()
    a, b = token_links.incidence(np.array([3, 4, 9]), 9), token_links.incidence(np.array([2, 9]), 9)
    overlap = token_links.row_products(a, b.transposed())
    assert list(zip(overlap.row_of_entry(), overlap.columns, overlap.values)) == [(0, 0, 2), (0, 1, 1), (1, 1, 1), (2, 1, 5)]


def cheapest_path(code):
    """The cheapest (cost, audit) over the grammar's states, row by row."""
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    def insert(best):
        todo = list(best)
        while todo:
            state = todo.pop()
            for letter in follows[state].replace("s", ""):
                way = (best[state][0] + 2, best[state][1] + "I")
                if letter not in best or way < best[letter]:
                    best[letter] = way
                    todo.append(letter)
        return best

    best = insert({"": (0, "")})
    for row in code:
        after = {}
        for state, (cost, audit) in best.items():
            ways = [(state, (cost + 3, audit + "D"))]
            if row != "-":
                stay = cost + (row.isupper() or row == "!")
                ways += [(x, (stay, audit + "K") if x == row.lower() else (stay + 2, audit + "R")) for x in follows[state] if x in ("u", "a", row.lower())]
            for x, way in ways:
                after[x] = min(after.get(x, way), way)
        best = insert(after)
    return min(best[s] for s in ("", "a") if s in best)


def test_alignment_equals_cheapest_path():
    rng = random.Random(2)
    for _ in range(1500):
        code = "".join(rng.choice("uauauauas?-SUA!") for _ in range(rng.randrange(30)))
        assert turns.repair(code) == cheapest_path(code)
        step = rng.randrange(1, 12)
        ways = turns.chain(turns.block_ways(code[i : i + step]) for i in range(0, len(code), step))
        assert min(ways["", end] for end in ("", "a") if ("", end) in ways) == cheapest_path(code)


def repair_one_by_one(table):
    def shown(value):
        return " " if value is None else str(value)

    out, conversations = [], defaultdict(list)
    for conv_id, turn, role, text in table:
        conversations[conv_id].append((turn, role, text))
    for conv_id, own in conversations.items():
        left = []
        for turn, role, text in sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, shown(r[1]), shown(r[2]))):
            fault = zlib.crc32(f"{shown(conv_id)}:{shown(turn)}".encode()) % 20
            text = "" if fault == 1 else shown(text).translate(dict.fromkeys(map(ord, ".!?"))) if fault == 2 else shown(text)
            left += [(turn, "user" if fault == 4 else shown(role), text)] * {0: 0, 3: 2}.get(fault, 1)
        code, seen, counts = "", set(), Counter()
        for _, role, text in left:
            ink = text.strip(" \t\n\v\f\r")
            letter = role[:1] if role[:1] in ("s", "u", "a") else "?"
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
            counts[fault] += 1
            code += "-" if fault in ("blank", "duplicate") else letter.upper().replace("?", "!") if fault else letter
            seen.add((role, text))
        known = [t for t, _, _ in left if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(left, left[1:]))
        cost, audit = cheapest_path(code)
        length, lines, at = len(audit) - audit.count("D"), [], 0
        goal = "s" * (length % 2) + "ua" * (length // 2)
        for edit in audit:
            if edit != "D":
                role = left[at][1] if edit == "K" else {"u": "user", "a": "assistant"}[goal[len(lines)]]
                lines.append(f"{role}:{'' if edit == 'I' else left[at][2]}")
            at += edit != "I"
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv_id, gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


REPAIRED = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_repair_query(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows(QUERIES["op13_turn_repair"](spark, SMALL), *REPAIRED) == repair_one_by_one(table)


def test_repair_of_long_and_awkward_conversations(spark, monkeypatch):
    monkeypatch.setattr(turns, "FAN", 4)  # several levels of joined blocks
    rng = random.Random(4)
    table = []
    for turn in range(600):
        role = rng.choice(["user", "assistant", "user", "assistant", "system", None, "tool", ""])
        text = rng.choice(["Hi.", "a b! ", "x", "", None, f"text {turn}.", f"text {turn}", "a?\n\t", "long. " * 500])
        table.append((1, turn if rng.random() > 0.05 else rng.choice([None, turn - 1]), role, text))
    for conv_id in (None, 2, 3):
        table += [(conv_id, turn, rng.choice(["user", "assistant"]), f"q{turn}.") for turn in range(rng.randrange(1, 70))]
    table += [(9, 1, None, None), (10, None, "user", "Hi.")] + [(11, 1, "user", "Hi.")] * 3
    df = spark.createDataFrame([(*r, 0, "x") for r in table], "conv_id bigint, turn bigint, role string, text string, pos int, audit string")
    assert rows(turns.report(df.repartition(5)), *REPAIRED) == repair_one_by_one(table)
    assert turns.report(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["string", "smallint", "decimal(12,2)"])
def test_embeddings_with_labels_of_any_type(spark, kind):
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    columns = ["vec_id", "n_links", "component_id", "kept"]
    other = vectors.withColumn("label", F.col("label").cast(kind))
    assert rows(epsilon_join.near_duplicates(other), *columns) == rows(epsilon_join.near_duplicates(vectors), *columns)
