"""The alignment of two tokenizers against one made from whole texts and decoded bytes."""

from __future__ import annotations

import hashlib
import random
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import pytest
import sentencepiece
from tokenizers import Tokenizer

from wattledger.llm import alignment, queries, stages
from wattledger.llm.common import table

PATHS = tuple(stages.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "  ", "\n", "a", "a ", "a  ", " a", "  a  b", "foo\n bar", "foo  \n bar", "x　 y",
    "é😀\U0001f9ff \U0001f9ffx", "a▁b c", "▁", "<0x41> <|endoftext|> <s> </s>", "a\x00b", "中文 text 漢字",
    "\x1c \x1d a", "a  b  c", "é ́x", "x" * 3000, "\U0001f9ff" * 50, "don't we'll  I'M", "tab\t tab\t\ttab ",
    " \n \n ", "1 22 333", "\r\n a\r\n", "​ ​", "﻿a ﻿", "日本語テキスト" * 30, "repeat " * 400,
]


class Brute:
    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        # GPT-style byte alphabet: the 256 one-byte tokens come first, in the order of bytes.
        alphabet = alignment.byte_alphabet()
        self.of_a = {i: bytes(alphabet[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.of_b = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.of_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.of_b)
        ]

    def groups(self, text):
        if not text:
            return []
        raw = (" " + text).encode()
        ids_a, ids_b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        parts_a, parts_b = [self.of_a[i] for i in ids_a], [self.of_b[i] for i in ids_b]
        if b"".join(parts_a) != raw or b"".join(parts_b) != raw:
            return []
        ends_a, ends_b = list(accumulate(map(len, parts_a))), list(accumulate(map(len, parts_b)))
        common = sorted(set(ends_a) & set(ends_b))
        out = [([], []) for _ in common]
        for side, (ids, ends) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
            for i, end in zip(ids, ends, strict=True):
                out[bisect_left(common, end)][side].append(i)
        return out

    def rows(self, docs):
        found = [(doc_id, self.groups(text)) for doc_id, text in docs]
        links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in found]
        held = Counter(p for c in links for p in c)
        most = Counter()
        for (x, _), n in held.items():
            most[x] = max(most[x], n)
        for (doc_id, g), c in zip(found, links, strict=True):
            text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
            yield (
                doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(c.values()),
                sum(n for p, n in c.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in c.items()),
                hashlib.sha256(text.encode()).hexdigest() if g else "",
            )


@pytest.fixture(scope="module")
def brute():
    return Brute()


def test_given_documents(spark, tables_dir, brute):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, tables_dir, "documents").collect()]
    got = queries.op12_token_alignment(spark, tables_dir)
    assert got.columns == [f.split()[0] for f in alignment.RESULT.split(", ")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute.rows(docs), key=repr)


def test_awkward_rows(awkward, brute):
    docs = [(r["doc_id"], r["text"]) for r in awkward.select("doc_id", "text").collect()]
    got = alignment.align(awkward, *PATHS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.rows(docs), key=repr)
    assert alignment.align(awkward.limit(0), *PATHS).collect() == []


def test_odd_texts_over_several_chunks(documents, brute, monkeypatch):
    chance = random.Random(1)
    letters = list("ab  \n\té▁😀\U0001f9ff .,'!1中\x00\x85 　") + ["  ", "the ", "'s", "tion"]
    made = ["".join(chance.choices(letters, k=chance.randrange(1, 40))) for _ in range(1500)]
    docs = list(enumerate(ODD + made))
    got = alignment.align(documents(docs).repartition(5), *PATHS).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(brute.rows(docs), key=repr)


def test_pieces_join_to_the_text_and_caches_turn(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    aligner = alignment.Aligner(*PATHS)
    for text in filter(None, ODD):
        assert "".join(aligner.pieces(text)) == " " + text
    words = [f" w{i}" for i in range(100)]
    first = [aligner.aligned([w])[0] for w in words]
    assert [aligner.aligned([w])[0] for w in words] == first
    assert len(aligner._new) <= 11


def test_long_runs_without_a_common_cut():
    """Tokens that share no cut for long are counted by distinct ids, not laid out."""
    aligner = alignment.Aligner(*PATHS)
    (found,) = aligner._align([" " + "\U0001f9ff" * 20_000])
    assert found is not None and found[0] > 0
