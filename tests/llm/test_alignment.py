"""Alignment of two tokenizers against a plain version over bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from fixtures import documents, texts
from tokenizers import Tokenizer

from tagloom.llm import alignment

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SHOWN = {chr(b): b for b in [*range(33, 127), *range(161, 173), *range(174, 256)]}
for b in range(256):
    if b not in SHOWN.values():
        SHOWN[chr(256 + len(SHOWN) - 188)] = b


def plain_tokens(text):
    if not text:
        return None
    ids = A.encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(SHOWN[c] for c in A.id_to_token(i))) for i in ids]
    right = []
    for i in B.encode(text):
        p = B.id_to_piece(i)
        right.append((i, bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode()))
    whole = b" " + text.encode()
    return (left, right) if b"".join(x for _, x in left) == whole == b"".join(x for _, x in right) else None


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain_version(rows):
    """The contract written out over all rows."""
    kept, counts = [], Counter()
    for doc_id, text, *_ in rows:
        found = plain_tokens(text)
        if not found:
            kept.append((doc_id, None))
            continue
        a, b = map(spans, found)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for lo, hi in zip([0, *ends], ends):
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in (a, b)))
        links, first = [], 0
        for i, s, e in a:
            while b[first][2] <= s:
                first += 1
            for j, s2, e2 in b[first:]:
                if s2 >= e:
                    break
                links.append((i, j))
        counts.update(set(links))
        kept.append((doc_id, (len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest())))
    best = defaultdict(int)
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = []
    for doc_id, x in kept:
        if x is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        out.append((doc_id, *x[:3], len(x[3]), sum(counts[p] == best[p[0]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]))
    return out


def key(row):
    return tuple((x is None, x) for x in row)


def test_alignment(spark):
    rows = [r if len(r[1] or "") < 50_000 else (r[0], r[1][:20_000], *r[2:]) for r in texts()]
    rows += [(200 + i, t, "en", "src0") for i, t in enumerate((
        "▁", "a▁b", " ", "  x  ", "<s> </s> <unk> <0x0A>", "<|endoftext|>", "\t\n", "été 漢字\U0001f600", "naïve  café", "\x00a", "ſ ﬁ Å"))]
    rows += [(None, "one two", "en", "src0")] + [(400 + i, "the same text again", "en", "src0") for i in range(1300)]
    got = alignment.align_tokenizers(documents(spark, rows)).select("doc_id", *alignment.MEASURES).collect()
    assert sorted(map(tuple, got), key=key) == sorted(plain_version(rows), key=key)
    assert alignment.align_tokenizers(documents(spark, [])).count() == 0


def test_pair_counts(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(["one two", "one  two", "one two", None, "two one one"])]
    aligned = alignment.aligned_texts(documents(spark, rows), *map(public_tokenizers.path, (alignment.BYTE_FILE, alignment.PIECE_FILE)))
    got = {(r["a"], r["b"]): r["documents"] for r in alignment.pair_counts(aligned, B.get_piece_size()).collect()}
    want = Counter()
    for _, t, *_ in rows:
        if found := plain_tokens(t):
            a, b = map(spans, found)
            want.update({(i, j) for i, s, e in a for j, s2, e2 in b if s < e2 and s2 < e})
    assert got == want


def test_parts_do_not_change_the_tokens():
    """Texts are cut only where neither vocabulary joins characters; with these parts it would show."""
    rng = random.Random(4)
    alphabet = "ab sS'tT\n\t\r  \x0b\x1c\x85\xa0éß漢 ​\U0001f600▁.,#12  "
    path = [public_tokenizers.path(f) for f in (alignment.BYTE_FILE, alignment.PIECE_FILE)]
    work = alignment.aligner(*path)
    for _ in range(2000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        cut = [p for p in alignment.parts(" " + text, 2)]
        assert "".join(cut) == " " + text
        for v in (work.a, work.b):
            assert [i for p in cut for i in v.encode(p)] == list(v.encode(" " + text))
