"""Operators 11 and 13 against numpy, exact whole numbers and round trips."""

import base64
import hashlib
import os

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from duotower.llm import warc, whitening
from duotower.llm.whitening import bidiagonalise, whitened_rows

VEC = "vec_id long, embedding array<float>, n long, component int"


def brute(x: np.ndarray, k: int):
    cov = np.cov(x.T, bias=True)
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1], u[:, ::-1]
    return e[:k], (x - x.mean(axis=0)) @ u[:, :k] / np.sqrt(e[:k]), e[:k] / e.sum()


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(3)
    full = (rng.standard_normal((700, 12)) * np.linspace(1, 4, 12)) @ rng.standard_normal((12, 12))
    rows = [(i, v.tolist(), 0, 0) for i, v in enumerate(full.astype(np.float32))]
    bad = [(900, None, 0, 0), (901, [], 0, 0), (902, [1.0] * 11 + [None], 0, 0), (903, [1.0] * 11 + [float("nan")], 0, 0),
           (904, [float("inf")] + [1.0] * 11, 0, 0), (905, [1.0, 2.0], 0, 0)]
    again = [(None, rows[0][1], 0, 0), rows[1]]         # a null id and a repeated row
    got = whitened_rows(spark.createDataFrame(rows + bad + again, VEC).repartition(5), k=5).toPandas()
    x = np.floor(64 * np.array([r[1] for r in rows + again], dtype=np.float32).astype(float))
    e, z, explained = brute(x, 5)
    assert len(got) == len(x) * 5 and set(got["n"]) == {len(x)} and got["identity_error"].max() < 1e-10
    exact = (len(x) * x.astype(int).astype(object) - x.astype(int).astype(object).sum(axis=0))
    deviation = (exact * exact).sum(axis=1)
    for i in (0, 5, 33, 699):
        mine = got[got.vec_id == i].sort_values("component")
        assert np.allclose(np.abs(mine["whitened"].astype(float)), np.abs(z[i]), atol=1e-9)
        assert np.allclose(mine["explained"].astype(float), explained, rtol=1e-9)
        assert {int(d) for d in mine["deviation"]} == {deviation[i]}
    once = got[(got.vec_id > 1)]
    for c in range(5):      # one sign for all rows of a component
        mine = once[once.component == c + 1].sort_values("vec_id")["whitened"].to_numpy(float)
        assert len(set(np.sign(mine * z[2:700, c]))) == 1


@pytest.mark.parametrize("rows", [[], [(1, None, 0, 0)], [(1, [1.0, 2.0], 0, 0)], [(1, [1.0, 2.0], 0, 0)] * 4])
def test_whitening_without_spread_gives_no_rows(spark, rows):
    out = whitened_rows(spark.createDataFrame(rows, VEC))
    assert out.count() == 0
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_drops_flat_directions_and_clamps(spark):
    rows = [(i, [float(i % 5), 2.0 * (i % 5), 7.0, float(i % 3)], 0, 0) for i in range(60)]
    got = whitened_rows(spark.createDataFrame(rows, VEC), k=32)
    assert got.agg(F.max("component")).first()[0] == 2         # rank two
    assert got.first()["identity_error"] < 1e-9
    huge = whitened_rows(spark.createDataFrame([(1, [3e38, 0.0], 0, 0), (2, [-3e38, 1.0], 0, 0), (3, [0.0, 5.0], 0, 0)], VEC))
    assert huge.count() >= 3


def test_bidiagonalisation_finds_every_copy_of_an_eigenvalue():
    """Spectra with multiple values, where one Krylov sequence ends early, and low rank."""
    rng = np.random.default_rng(0)
    for values in ([5.0] * 6, [4.0, 4.0, 4.0, 1.0, 1.0, 0.5], [3.0, 3.0, 0.0, 0.0, 0.0, 0.0], [9.0, 1e-3, 1e-3, 1e-3, 1e-6, 1e-6]):
        u, _ = np.linalg.qr(rng.standard_normal((40, 6)))
        w, _ = np.linalg.qr(rng.standard_normal((6, 6)))
        x = u * values @ w.T

        def products(a):
            p = x @ a
            return x.T @ p, float(p @ p)

        got, vectors, _ = bidiagonalise(products, 6, float((x * x).sum()), 4)
        assert np.allclose(got, sorted(values, reverse=True)[:4], atol=1e-9)
        assert np.allclose(vectors @ vectors.T, np.eye(4), atol=1e-12)
        assert np.allclose(np.linalg.norm(x @ vectors.T, axis=0), got, atol=1e-9)


def test_steps_stop_when_the_rest_of_the_variance_is_small():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 60)) * np.r_[np.linspace(50, 20, 5), np.full(55, 0.01)]
    got, _, steps = bidiagonalise(lambda a: (x.T @ (x @ a), float((x @ a) @ (x @ a))), 60, float((x * x).sum()), 5)
    assert np.allclose(got, np.linalg.svd(x, compute_uv=False)[:5], rtol=1e-12) and steps < 30


def test_whitened_rows_do_not_depend_on_partitions(spark):
    e = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    one, many = (whitened_rows(e.repartition(n), k=4).orderBy("vec_id", "component").toPandas() for n in (1, 7))
    assert np.allclose(one["whitened"], many["whitened"], atol=1e-9) and (one["deviation"] == many["deviation"]).all()


def test_exact_deviations_beyond_64_bits():
    y = np.array([[1 << 40, -(1 << 40)], [3, 4]])
    sums = [int(s) for s in y.sum(axis=0)]
    assert whitening.deviations(y, 2, sums) == [sum((2 * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in y]


# ---------------------------------------------------------------- WARC

PAGES = "page_id long, url string, html string, payload string, row int"


def expected(rows, least=0):
    """By a plain loop: (page_id, n, digest, type, refers_to), sorted."""
    best = {}
    for i, r in enumerate(rows):
        p = (r[2] or "").encode()
        if len(p) >= least:
            best.setdefault(p, []).append((r[0] is not None, r[0] or 0, i))
    out = []
    for i, r in enumerate(rows):
        p = (r[2] or "").encode()
        top = max(best[p])[2] if p in best else i
        same = p in best and top != i and rows[top][0] == r[0]
        kind = "response" if top == i else "revisit"
        out.append((r[0], len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), kind, None if kind == "response" else rows[top][0]))
        assert not same or kind == "revisit"
    return sorted(out, key=str)


def warc_rows():
    text = "<html><body>" + "lorem ipsum dolor sit amet. " * 20
    rows = [(i, f"http://a.example/{i}", f"{text}{i % 37} ünïcödé</body></html>", "x", 1) for i in range(300)]
    rows += [(1000 + i, "http://b.example/ x\r\ny", "copy", "x", 1) for i in range(200)]
    rows += [(2000, None, None, "x", 1), (2001, "u", "", "x", 1), (None, "n", "copy", "x", 1), (None, "n", "only null", "x", 1),
             (3000, "r", "twice", "x", 1), (3000, "r", "twice", "x", 1), (3001, "", "P*M\x18\0\0\0\0\r\n\r\nWARC/1.1\r\n", "x", 1),
             (3002, "long", "z" * 3_000_000 + "é", "x", 1)]
    return rows


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, tmp_path, least):
    rows = warc_rows()
    path = str(tmp_path / "archives")
    back = warc.warc_round_trip(spark.createDataFrame(rows, PAGES).repartition(3), least, archive_bytes=1 << 20, path=path)
    got = back.collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows, least)
    texts = {(i, (h or "").encode()) for i, _, h, _, _ in rows}
    assert all((r.page_id, r.payload) in texts for r in got if r.record_type == "response")
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) > 1
    for f in files:
        data = (tmp_path / "archives" / f).read_bytes()
        assert data[:4] == warc.DICT_FRAME and data[8:12] == b"\x37\xa4\x30\xec"      # a dictionary comes first
        # an independent reader: the library's stream reader over all frames, with the embedded dictionary
        d = zstandard.ZstdCompressionDict(data[8:8 + int.from_bytes(data[4:8], "little")])
        whole = zstandard.ZstdDecompressor(dict_data=d).stream_reader(data, read_across_frames=True).read()
        assert whole == b"".join(warc.read_frames(data)) and whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")


def test_archives_of_few_rows_have_no_dictionary(spark, tmp_path):
    rows = [(1, "u", "a", "x", 1)]
    path = str(tmp_path / "few")
    got = warc.warc_round_trip(spark.createDataFrame(rows, PAGES), path=path).collect()
    assert [(r.page_id, r.payload, r.record_type) for r in got] == [(1, b"a", "response")]
    assert warc.warc_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_damaged_archives_are_noticed(spark, tmp_path):
    frame = zstandard.ZstdCompressor().compress(warc.build_record(0, 1, "u", b"abc", 3, "A" * 32, None))
    (tmp_path / "x.txt").write_bytes(frame)
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archives(spark, str(tmp_path)).count()
    (tmp_path / "x.txt").write_bytes(frame[:-9])
    with pytest.raises(Exception, match="ends within|zstd"):
        warc.read_archives(spark, str(tmp_path)).count()


def test_dictionary_helps(spark, tmp_path):
    """Small records compress better with the embedded dictionary than alone."""
    rows = [(i, f"http://a.example/{i}", f"<html><head><title>page {i}</title></head><body><p>" + " ".join(f"w{(i * k) % 97}" for k in range(60)), "x", 1)
            for i in range(2000)]
    path = str(tmp_path / "d")
    warc.warc_round_trip(spark.createDataFrame(rows, PAGES), path=path).count()
    size = sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.startswith("part-"))
    alone = sum(len(zstandard.ZstdCompressor(level=3).compress(warc.build_record(0, i, u, h.encode(), len(h), "A" * 32, None))) for i, u, h, _, _ in rows)
    assert size < 0.8 * alone
