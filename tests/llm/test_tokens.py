"""Packing and tokenizer alignment against plain encoders and brute force."""

import hashlib
import os
import sys
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

sys.path.insert(0, os.path.dirname(__file__))
from helpers import documents, frame  # noqa: E402

from ledgerlake.llm import alignment, packing, tokens  # noqa: E402

ODD = ["a  b", "a \nb", "a\n b", "a\n  b", " lead", "trail ", "  ", "x▁y", "café 日本 <s> </s> <|endoftext|> \u0000 z",
       "it's  don't\t\tx", "a  b 　 c", "​ ﻿ x", "é ﬁ x́", "\n", "a   \n\n  b ", "A B C\x1cD \x85E",
       "I'M we'Ll <|startoftext|>x"]


def all_rows():
    return documents(60) + [(7000 + i, t) for i, t in enumerate(ODD)] + [(8000, "lorem ipsum dolor " * 60_000),
                                                                        (8001, "ab" * 150_000)]


# ---------------------------------------------------------------- packing

def plain_pieces(rows, capacity):
    encoder, out = Tokenizer.from_file(tokens.tokenizer_path(packing.TOKENIZER)), Counter()
    for i, text in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [0]
        for k, s in enumerate(range(0, len(ids), capacity)):
            part = np.array(ids[s:s + capacity], "<u4")
            out[(i, k, s, len(part), zlib.crc32(part.tobytes()))] += 1
    return out


def least_by_decreasing_best_fit(lengths, capacity):
    gaps, n = packing.Gaps(), 0
    for size in sorted(lengths, reverse=True):
        room, _ = gaps.successor(size) or (0, 0)
        n += not room
        if (room or capacity) > size:
            gaps.add((room or capacity) - size, 0)
    return n


@pytest.mark.parametrize("capacity,sweep_rows", [(2048, 200_000), (64, 40)])
def test_packing_holds_every_piece_and_wastes_little(spark, monkeypatch, capacity, sweep_rows):
    monkeypatch.setattr(packing, "SWEEP_ROWS", sweep_rows)
    rows = all_rows()
    got = packing.pack_documents(frame(spark, rows), capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == plain_pieces(rows, capacity)
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by_seq) <= least_by_decreasing_best_fit([r.length for r in got], capacity) * 1.01 + 1


def test_packing_many_equal_lengths(spark, monkeypatch):
    """One length held by most documents is spread over ranges; a range leaves at most one half alone."""
    monkeypatch.setattr(packing, "SWEEP_ROWS", 50)
    rows = [(i, "a " * 1023) for i in range(300)] + [(1000 + i, None) for i in range(300)]
    got = packing.pack_documents(frame(spark, rows), 2048).collect()
    assert len(got) == 600 and len({r.sequence_id for r in got}) <= 150 + 600 // 50


def test_packing_empty_table(spark):
    assert packing.pack_documents(frame(spark, [(1, "x")]).limit(0)).collect() == []


def test_deal_takes_the_smallest_gaps_before_a_range():
    assert packing.deal([(0, 0, 3), (1, 2, 1), (2, 5, 0)]) == [(1, 0, 0, 2, 2), (2, 0, 1, 0, 1), (2, 1, 0, 0, 1)]


# ---------------------------------------------------------------- alignment

def plain_alignment(rows):
    enc = Tokenizer.from_file(tokens.tokenizer_path(alignment.TOKENIZER_A))
    enc.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=tokens.tokenizer_path(alignment.TOKENIZER_B))
    letters, docs, counts = alignment.byte_letters(), [], Counter()
    for i, text in rows:
        a = [(k, bytes(letters[c] for c in enc.id_to_token(k)))
             for k in enc.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(k, bytes([int(w[3:5], 16)]) if pieces.is_byte(k) else w.replace("▁", " ").encode())
             for k, w in ((k, pieces.id_to_piece(k)) for k in pieces.encode(text))] if text else []
        if not text or any(b"".join(x for _, x in s) != (" " + text).encode() for s in (a, b)):
            docs.append((i, None))
            continue
        ends = [dict(zip(np.cumsum([len(x) for _, x in s]).tolist(), range(len(s)))) for s in (a, b)]
        groups, links, at = [], [], (0, 0)
        for end in sorted(set(ends[0]) & set(ends[1])):
            to = ends[0][end] + 1, ends[1][end] + 1
            groups.append("|".join(",".join(str(k) for k, _ in s[lo:hi]) for s, lo, hi in zip((a, b), at, to)))
            links.append((a[to[0] - 1][0], b[to[1] - 1][0]))
            at = to
        counts.update(links)
        docs.append((i, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return Counter((i, 0, 0, 0, 0, 0, 0, "") if d is None else
                   (i, *d[:3], len(d[3]), sum(counts[x] == most[x[1]] for x in d[3]), sum(counts[x] for x in d[3]), d[4])
                   for i, d in docs)


@pytest.mark.parametrize("frequent_pairs", [400_000, 20, 1])
def test_alignment_equals_brute_force(spark, frequent_pairs):
    rows = all_rows()
    got = alignment.align_tokenizers(frame(spark, rows), frequent_pairs=frequent_pairs).collect()
    assert Counter(tuple(r)[:8] for r in got) == plain_alignment(rows)
    assert all(r.n_overlaps == r.n_a + r.n_b - r.n_groups for r in got)


def test_alignment_of_many_cuts_in_few_calls():
    """Cuts are aligned together: the same as one by one, those that the bytes do not give back among them, and
    only the encoder is called for each."""
    import cProfile
    import pstats
    aligned = alignment.Aligned(alignment.TOKENIZER_A, alignment.TOKENIZER_B)
    cuts = [f"{w}{k}" for k in range(500) for w in ("plain", "▁", "don't", "<|endoftext|>", "a\u3000b", "né", "\t", "x\n", "<s>")]
    cuts += ["plain", " two  blanks ", "▁"]
    profile = cProfile.Profile()
    together = profile.runcall(aligned, cuts)
    assert together == [x for c in cuts for x in aligned([c])]
    assert None in together and sum(x is None for x in together) < len(cuts) / 2
    assert aligned(["▁"]) == [None] and aligned([]) == []
    assert pstats.Stats(profile).total_calls < 10 * len(cuts)
    # other bytes of the same number
    plain, i = aligned(["plain", "cut"]), aligned.b(["plain"])[0][-1]
    aligned.parts[1][i] = b"?" * len(aligned.parts[1][i])
    assert aligned(["cut", "plain", "cut"]) == [plain[1], None, plain[1]]


def test_alignment_empty_table(spark):
    assert alignment.align_tokenizers(frame(spark, [(1, "x")]).limit(0)).collect() == []
    assert [tuple(r) for r in alignment.align_tokenizers(frame(spark, [(1, None)])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", 0)]


def test_cuts_do_not_change_the_tokens():
    a, b = alignment.SideA(alignment.TOKENIZER_A), alignment.SideB(alignment.TOKENIZER_B)
    for text in ODD:
        cuts = alignment.cuts_of(text)
        assert " ".join(cuts) == text
        assert sum(a(cuts), []) == a([text])[0]
        if "▁" not in text:
            assert sum(b(cuts), []) == b([text])[0]


def test_words_are_encoded_as_in_their_text(monkeypatch):
    encoder = Tokenizer.from_file(tokens.tokenizer_path(packing.TOKENIZER))
    monkeypatch.setattr(tokens, "KNOWN_PIECES", 5)
    ids, texts = tokens.WordIds(packing.TOKENIZER), [t for _, t in all_rows()[:80]] + ODD + ["Don't stop... it's 3.5, really?! ÀÉ ÇA. İx ΣΑΣ. x<|endoftext|>.", None]
    for _ in range(2):
        for k in range(0, len(texts), 7):
            want = [np.array(encoder.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts[k:k + 7]]
            assert ids(texts[k:k + 7]) == want


def test_words_of_latin_letters_and_their_marks_take_the_short_way():
    """Only the model sees them, which has no normaliser and parts nothing; the whole tokenizer is left the few others."""
    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.model, self.asked = tokenizer, tokenizer.model, []

        def encode_batch_fast(self, pieces, **options):
            self.asked += pieces
            return self.tokenizer.encode_batch_fast(pieces, **options)

    ids = tokens.WordIds(packing.TOKENIZER)
    plain = ids.tokenizer
    ids.tokenizer = counted = Counted(plain)
    letters = [chr(k) for k in range(0xAA, 0x100) if chr(k).isalpha()]
    words = [f"{a}{b}{end}" for a in letters for b in ("", "x", "ÉT") for end in ("", ",", ".###", "&&&")]
    text = " ".join([*words, "Ж日", "e\u0301", "<|endoftext|>", "don't", "3.5"])
    assert ids([text]) == [np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert len(counted.asked) < 12 < len(words)


def test_repeated_words_make_no_python_objects():
    """A batch is parted, numbered and put together as columns; Python sees its distinct pieces only."""
    import tracemalloc
    ids, texts = tokens.WordIds(packing.TOKENIZER), ["lorem ipsum, dolor\nétoile " * 1000, None, ""] * 40
    want = ids(texts[:3])
    tracemalloc.start()
    got = ids(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == want * 40 and want[1:] == [b"", b""] and ids([]) == [] and ids([None]) == [b""]
    assert peak < 3 * sum(map(len, got))


def test_batches_of_texts_end_anywhere(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate([None, "", "a b", None, "été, x " * 30, "", "a", None])]
    for size in (1, 3, 50, 10_000):
        monkeypatch.setattr(packing, "BATCH_BYTES", size)
        got = packing.document_pieces(frame(spark, rows).coalesce(1), 16).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == plain_pieces(rows, 16)
        assert len({r.uid for r in got}) == len(got)


def test_memory_keeps_what_is_asked_for():
    asked = []
    r = tokens.Remembered(lambda ps: (asked.extend(ps), [p.upper() for p in ps])[1], 3)
    for pieces in ({"a", "b"}, {"a", "c", "d"}, {"a", "e"}, {"a", "x" * 100}, {"f", "g", "h", "a"}, {"a"}):
        known = r(pieces)
        assert all(known[p] == p.upper() for p in pieces)
    assert asked.count("a") == 1 and len(r.known) + len(r.before) <= 8
