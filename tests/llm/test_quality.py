import zstandard

from wattledger.llm import quality

from .conftest import given, same_rows, spaced


def brute(text):
    words = spaced(text)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    lines = [x for x in (text or "").split("\n") if spaced(x)]
    counts = (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    return *counts, failed, not failed and quality.bands((text or "").encode(), packer)[3] is None


def test_judge_agrees_with_brute_force(docs):
    got = quality.judge(docs)
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    same_rows([tuple(r) for r in got.select(*names).collect()], [(i, *brute(t)) for i, t in given(docs)])


def test_filtered_keeps_the_same_rows_unchanged(docs):
    want = [tuple(r) for r in docs.collect() if brute(r["text"])[-1]]
    same_rows([tuple(r) for r in quality.filtered(docs).collect()], want)
    assert want and len(want) < docs.count()


def test_empty_table(empty):
    assert quality.judge(empty).count() == 0 and quality.filtered(empty).count() == 0


def test_bands_reject_repeats_and_noise():
    import random
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    draw = random.Random(3)
    prose = " ".join("".join(draw.choice(["an", "th", "er", "in", "on", "re"]) for _ in range(draw.randrange(1, 4))) for _ in range(3000))
    assert quality.bands(prose.encode(), packer)[3] is None
    assert quality.bands(b"again and again " * 500, packer)[3] == "repetitive"
    assert quality.bands(draw.randbytes(6000), packer)[3] == "incompressible"
    # half the chunks are noise: the whole text is still in its band
    mixed = prose.encode()[:8192] + draw.randbytes(8192 + 4096)
    assert quality.bands(mixed, packer)[1:3] == (5, 3) and quality.bands(mixed, packer)[3]
    assert quality.bands(b"", packer) == (None, 0, 0, None)


def every_byte(text):
    """(chunks, bad chunks, share of bad bytes), each byte judged by its own full chunk or else by the last 4,096 bytes."""
    packer = zstandard.ZstdCompressor(level=3)
    full = len(text) // 4096
    parts = [text[4096 * k:4096 * (k + 1)] for k in range(full)] + [text[-4096:]] * (len(text) % 4096 > 0)
    bad = [not 1.4 <= 4096 / len(packer.compress(p)) <= 8 for p in parts]
    return len(parts), sum(bad), sum(bad[min(i // 4096, len(parts) - 1)] for i in range(len(text))) / len(text)


def test_no_byte_is_left_out_of_the_chunks():
    import random
    packer = zstandard.ZstdCompressor(level=quality.LEVEL)
    draw = random.Random(5)
    prose = " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randrange(2, 9))) for _ in range(4000)).encode()
    kinds = [prose, b"=" * 20_000, draw.randbytes(20_000)]
    texts = [prose[:4096] + b"=" * 8191, b"=" * 4096 + prose[:4095], b"=" * 4096 + prose[:4097], prose[:4096] + draw.randbytes(4095), prose[:4097]]
    for _ in range(60):
        texts.append(b"".join(draw.choice(kinds)[:draw.choice([1, 700, 4095, 4096, 5000, 8191])] for _ in range(draw.randrange(1, 5))) + prose[:4097])
    reasons = set()
    for text in texts:
        ratio, chunks, bad, reason = quality.bands(text, packer)
        want = every_byte(text)
        assert (chunks, bad) == want[:2]
        if reason in (None, "chunks"):
            assert (reason == "chunks") == (want[2] > 0.5)
        reasons.add(reason)
    assert {None, "chunks"} <= reasons
    # the tail of junk is judged: two thirds of the bytes are out of band, and the whole text is in its band
    ratio, chunks, bad, reason = quality.bands(texts[0], packer)
    assert 1.5 <= ratio <= 8 and (chunks, bad, reason) == (3, 2, "chunks")
    assert quality.bands(texts[2], packer)[1:] == (3, 1, None)
