import hashlib
import math
import random
import struct

import pytest

from weftline.llm import flac, flac_frames


def payloads(seed):
    rng = random.Random(seed)
    texts = [b"", b"a", b"The quick brown fox. " * 40, bytes(rng.randrange(256) for _ in range(3000)), bytes(5000), b"\xff\x00" * 700, "éè漢字 word ".encode() * 9000]
    texts += [bytes(rng.choice(b"abcd e") for _ in range(rng.randint(1, 1200))) for _ in range(30)]
    return [flac.payload_of(t) for t in texts]


@pytest.mark.parametrize("lpc", [None, (10, [1500, -600]), (12, [7000, -3000, 512, -100, 9])])
def test_round_trip(lpc):
    p = payloads(1)
    media = flac.encode(p, lpc)
    assert flac.decode(media) == p
    assert flac.decode(media[2:3]) == p[2:3]


def test_sound_becomes_smaller():
    p = [bytes(int(128 + 100 * math.sin(i / 20)) for i in range(8192))]
    assert len(flac.encode(p)[0]) < len(p[0]) / 2


def test_damage_is_noticed():
    m = bytearray(flac.encode([flac.payload_of(b"some text of this stream " * 50)])[0])
    for at in (len(m) - 1, len(m) - 40, 200):
        bad = bytearray(m)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            flac.decode([bytes(bad)])


def test_frame_numbers_of_two_and_three_bytes():
    p = [bytes(i % 251 for i in range(256 * 2100))]
    assert flac.decode(flac.encode(p)) == p


def test_rows_and_blocks(spark):
    rows = [(1, "héllo " * 100, "x"), (2, None, None), (2, "", "y"), (None, "z" * 600, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, media string")
    out = flac.media_features(docs).collect()
    assert len(out) == 4 and {r.payload_bytes % 64 for r in out} == {0}
    assert len({r.media_sha256 for r in out if r.n_bytes == 0}) == 1
    blocks = flac.pcm_blocks(flac.media_rows(docs)).where("id = 1").orderBy("block").collect()
    assert b"".join(bytes(r.pcm) for r in blocks) == flac.payload_of(rows[0][1].encode())
    assert [r.sample_offset for r in blocks] == [256 * i for i in range(len(blocks))]
    assert flac.media_features(docs.where("false")).collect() == []


@pytest.mark.parametrize("lpc", [None, (12, [7000, -3000, 512, -100, 9])])
def test_an_independent_reader_understands_the_streams(lpc):
    p = [x[:4096] for x in payloads(2)]
    for data, want in zip(flac.encode(p, lpc), p):
        assert flac_frames.payload(data, flac.Stream(data)) == want


def test_reading_from_a_sample_on():
    p = payloads(3)
    media = flac.encode(p)
    rng = random.Random(4)
    for count in (1, 64, 700):
        first = [rng.randrange(len(x)) for x in p]
        assert flac.read_at(media, first, count) == [x[f : f + count] for x, f in zip(p, first)]


def other_stream(samples, parts, blocks=(192,), rice=1, seek=False):
    """A stream as another encoder may write it: order 2, several partitions of 5-bit parameters, one of them escaped."""
    frames, at = b"", 0
    for k, block in enumerate(blocks):
        x = samples[at : at + block]
        at += block
        bits = ""
        put = lambda v, n: format(v & ((1 << n) - 1), f"0{n}b") if n else ""
        bits += "0" + put(10, 6) + "0" + put(x[0], 8) + put(x[1], 8) + put(1, 2) + put(parts, 4)
        r = [x[i] - 2 * x[i - 1] + x[i - 2] for i in range(2, block)]
        for j in range(1 << parts):
            own, r = (r[: (block >> parts) - 2], r[(block >> parts) - 2 :]) if j == 0 else (r[: block >> parts], r[block >> parts :])
            if j == 1:
                bits += put(31, 5) + put(11, 5) + "".join(put(v, 11) for v in own)
            else:
                bits += put(rice, 5)
                for v in own:
                    u = v * 2 if v >= 0 else -v * 2 - 1
                    bits += "0" * (u >> rice) + "1" + put(u, rice)
        bits += "0" * (-len(bits) % 8)
        head = bytes([0xFF, 0xF8, 0x70, 0x02, k]) + struct.pack(">H", block - 1)
        head += bytes([flac_frames.checksum(head, 0x07, 8)])
        body = head + int(bits, 2).to_bytes(len(bits) // 8, "big")
        frames += body + struct.pack(">H", flac_frames.checksum(body, 0x8005, 16))
    raw = bytes(v & 0xFF for v in samples[:at])
    info = struct.pack(">HH", min(blocks), max(blocks)) + bytes(6) + ((8000 << 44) | (7 << 36) | at).to_bytes(8, "big") + hashlib.md5(raw).digest()
    table = bytes([3]) + (18).to_bytes(3, "big") + struct.pack(">QQH", 0, 0, blocks[0]) if seek else b""
    return b"fLaC" + bytes([0]) + len(info).to_bytes(3, "big") + info + table + bytes([0x84, 0, 0, 8]) + bytes(8) + frames, bytes((v + 128) & 0xFF for v in samples[:at])


def test_streams_of_other_encoders():
    rng = random.Random(5)
    samples = [max(-128, min(127, int(60 * math.sin(i / 9)) + rng.randint(-3, 3))) for i in range(2000)]
    for parts, blocks, seek in ((0, (192,), False), (2, (192, 576, 64), False), (3, (256,), True)):
        data, want = other_stream(samples, parts, blocks, seek=seek)
        mine = flac.encode([want])[0]
        assert flac.decode([data, mine, data]) == [want] * 3
        assert flac.read_at([data, mine], [70, 70], 64) == [want[70:134]] * 2
        bad = bytearray(data)
        bad[-9] ^= 1
        with pytest.raises(ValueError):
            flac.decode([bytes(bad)])


def test_seek_points_beyond_one_table(monkeypatch):
    monkeypatch.setattr(flac, "POINTS", 5)
    p = [bytes(i % 251 for i in range(256 * 23 + 64)), b"a" * 64]
    media = flac.encode(p)
    assert flac.decode(media) == p and flac.read_at(media, [256 * 20 + 3, 0], 9) == [p[0][256 * 20 + 3 :][:9], b"a" * 9]
