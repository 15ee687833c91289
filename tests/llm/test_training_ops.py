"""Whitening, quality classifier and fill-in-the-middle beside plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from machpulse.llm import classifier, infill, linear, queries, whitening
from tests.llm.cases import CLASHES, documents, messy, prose

SF_DIR = "/root/testdata/sf0.001"


# Whitening


def plain_whitening(rows, components=16):
    """Rows (id, vector) as whole numbers, deviations and the eigenvalues of their covariance."""
    good = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            good.append((i, [math.floor(64 * c) + 1_000_000 for c in v]))
    listed = sorted({tuple(x) for _, x in good})
    n, sums = len(listed), [sum(column) for column in zip(*listed)]
    deviations = sorted(((i, sum((n * x - s) ** 2 for x, s in zip(v, sums))) for i, v in good), key=str)
    centred = np.array([[(n * x - s) / n for x, s in zip(v, sums)] for v in listed])
    values = np.linalg.eigvalsh(centred.T @ centred / n)[::-1]
    return n, deviations, values, good, sums


def vectors(spark, rows, kind="float"):
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, label int")
    return frame.selectExpr("*", *[f"'x' AS {name}" for name in [*CLASHES, "dim", "packed", "component"]])


def test_whitening_equals_the_plain_eigenvectors(spark):
    rng = np.random.default_rng(3)
    turned = rng.standard_normal((24, 24)) * np.geomspace(1, 0.02, 24)
    rows = [(i, [float(np.float32(c)) for c in rng.standard_normal(24) @ turned]) for i in range(400)]
    rows += [(500, rows[3][1]), (501, rows[3][1]), (None, rows[4][1]), (502, None), (503, [1.0] * 23 + [None]), (504, [float("nan")] * 24)]
    rows += [(505, [float("inf")] * 24), (506, [1.0] * 5), (507, [])]
    found = whitening.whiten(vectors(spark, rows)).collect()
    kept = [r for r in rows if r[0] not in (506, 507)]
    n, deviations, values, good, sums = plain_whitening(kept)
    assert n == 400 and {r.n for r in found} == {n} and len(found) == 16 * len(good)
    firsts = [(r.vec_id, r.deviation) for r in found if r.component == 1]
    assert sorted(firsts, key=str) == sorted(deviations, key=str)
    explained = {r.component: r.explained for r in found}
    assert np.allclose([explained[k] for k in range(1, 17)], values[:16] / values.sum(), rtol=1e-9)
    assert max(r.identity_error for r in found) < 1e-9
    # Each component is an eigenvector up to its sign: columns of whitened values over the fit list.
    listed = {r.vec_id for r in found if r.vec_id is not None and r.vec_id < 400}
    table = {(r.vec_id, r.component): r.whitened for r in found if r.vec_id in listed}
    white = np.array([[table[i, k] for k in range(1, 17)] for i in sorted(listed)])
    centred = np.array([[x - s / n for x, s in zip(v, sums)] for i, v in sorted((g for g in good if g[0] in listed))])
    assert np.allclose(np.abs(np.sum(centred.T @ white / n * (centred.T @ white / n), axis=0)), values[:16], rtol=1e-8)


def test_whitening_of_flat_and_dependent_vectors(spark):
    assert whitening.whiten(vectors(spark, [])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, []), (2, None)])).count() == 0
    rng = np.random.default_rng(4)
    # The third entry is the sum of the others, the fourth never changes.
    rows = [(i, [a / 64, b / 64, (a + b) / 64, 3.0]) for i, (a, b) in enumerate(rng.integers(-60, 60, (200, 2)).tolist())]
    found = whitening.whiten(vectors(spark, rows, "double")).collect()
    _, deviations, values, _, _ = plain_whitening(rows)
    assert {r.component for r in found} == {1, 2} and max(r.identity_error for r in found) < 1e-6
    assert np.allclose(sorted({r.explained for r in found}, reverse=True), values[:2] / values.sum(), rtol=1e-6)
    assert sorted(((r.vec_id, r.deviation) for r in found if r.component == 1), key=str) == deviations


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * i, -1e8 * i * i, 1.0]) for i in range(9)] + [(10, [1e300, 0.0, 0.0])]
    found = whitening.whiten(vectors(spark, rows, "double")).collect()
    _, deviations, _, _, _ = plain_whitening(rows[:-1])
    want = {i: d if d < 2**63 else None for i, d in deviations}
    assert {r.vec_id: r.deviation for r in found if r.component == 1} == want


def test_qr_of_ill_conditioned_rows():
    """Singular values far below the square root of the precision survive, where the covariance loses them."""
    rng = np.random.default_rng(5)
    left = np.linalg.qr(rng.standard_normal((500, 12)))[0]
    right = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    singular = np.geomspace(1, 1e-11, 12)
    rows = left * singular @ right.T

    def gram(factors):
        held = rows
        for factor in factors:
            held = linear.solve_rows(held, factor)
        return held.T @ held

    composed, _ = whitening.shifted_cholesky_qr(gram, 12, 500)
    assert np.allclose(np.linalg.svd(composed)[1], singular, rtol=1e-2, atol=0)
    assert not np.allclose(np.sqrt(np.abs(np.linalg.eigvalsh(rows.T @ rows)[::-1])), singular, rtol=1e-2, atol=0)


def test_summed_adds_what_tasks_make(spark):
    frame = spark.range(0, 1000, 1, 7).selectExpr("cast(id AS double) AS v")

    def partial(batches):
        total = None
        for batch in batches:
            v = batch.column("v").to_numpy()
            total = np.array([v.sum(), (v * v).sum(), len(v)]) + (0 if total is None else total)
        return total

    assert list(linear.summed(frame, 3, partial)) == [499500.0, 332833500.0, 1000.0]
    assert list(linear.summed(frame.limit(0), 3, partial)) == [0.0, 0.0, 0.0]


# Fill in the middle


def plain_infill(doc_id, text, unit=r"[^\n]*\n|[^\n]+", rate=100, spm_rate=50, seed=7):
    text = text or ""
    parts = re.findall(unit, text, re.S)
    n, hexed = len(parts), hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * k: 8 * k + 8], 16) for k in range(4))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(p) for p in (parts[:first], parts[first:last], parts[last:]))
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def hard_texts():
    rng = random.Random(8)
    rows = [(i, t) for i, t, _ in messy()]
    rows += [(200 + i, "".join(rng.choice("ab é日😀\n\r<>PSM") for _ in range(rng.randint(0, 80)))) for i in range(300)]
    rows += [(600, "\n\n\n"), (601, "no feed"), (602, "a<P>b\nc"), (603, "x\n" * 20_000 + "é"), (604, "<S"), (605, "<P<S\n>\n<M"), (606, "é" * 50_000)]
    return rows


@pytest.mark.parametrize("options", [{}, {"rate": 60, "spm_rate": 20, "seed": 3}, {"unit": "char"}])
def test_infill_equals_the_plain_version(spark, options):
    rows = hard_texts()
    found = infill.infill(documents(spark, [(i, t, "s") for i, t in rows]), **options)
    want = [plain_infill(i, t, **{**options, **({"unit": "."} if "unit" in options else {})}) for i, t in rows]
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)


def test_infill_is_undone(spark):
    rows = hard_texts()
    made = infill.digests(documents(spark, [(i, t, "s") for i, t in rows])).collect()
    want = [(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows]
    assert sorted(((r.doc_id, r.restored_sha256) for r in made), key=str) == sorted(want, key=str)
    outputs = {(p[0], hashlib.sha256(p[5].encode()).hexdigest()) for p in (plain_infill(i, t) for i, t in rows)}
    assert {(r.doc_id, r.output_sha256) for r in made} == outputs
    assert infill.digests(documents(spark, [])).count() == 0


def test_whole_table_is_infilled(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    found = {r.doc_id: r for r in queries.op13_infill(spark, SF_DIR).collect()}
    assert len(found) == len(docs)
    for doc in docs:
        _, n, form, prefix, middle, output = plain_infill(doc.doc_id, doc.text)
        row = found[doc.doc_id]
        assert (row.n, row.form, row.prefix_chars, row.middle_chars) == (n, form, prefix, middle)
        assert row.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert row.restored_sha256 == hashlib.sha256((doc.text or "").encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=40))
def test_exception_index_converts_both_ways(text):
    index = infill.ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
    assert index.size() == len(text)
    for point in range(len(text) + 1):
        byte = len(text[:point].encode())
        assert index.byte_offset(point) == byte and index.code_points(byte) == point


# Quality classifier


def shout(rng, count):
    return " ".join(prose(rng, 1).upper() + "!!" for _ in range(count))


def is_held_out(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 5 == 0


def labelled(spark, good=150, bad=60):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(20, 200)), "s") for i in range(good)]
    rows += [(1000 + i, shout(rng, rng.randint(20, 200)), "s") for i in range(bad)]
    return rows, [(i, int(i < 1000)) for i, _, _ in rows]


def label_frame(spark, marks):
    return spark.createDataFrame([(i, q, 0) for i, q in marks], "doc_id long, quality int, toxic int")


def test_held_out_labels_are_found_and_never_read(spark):
    rows, marks = labelled(spark)
    docs = documents(spark, rows)
    found = classifier.classify(docs, label_frame(spark, marks)).collect()
    assert all(r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    held = [r for r in found if r.held_out]
    assert len(held) > 25 and all(r.predicted == int(r.doc_id < 1000) for r in held)
    other = [(i, 1 - q if is_held_out(i) else q) for i, q in marks]
    again = classifier.classify(docs, label_frame(spark, other)).collect()
    assert sorted((r.doc_id, round(r.score, 9)) for r in found) == sorted((r.doc_id, round(r.score, 9)) for r in again)


def test_scores_come_from_the_text_alone(spark):
    rows, marks = labelled(spark)
    moved = [(i, t, "other") for i, t, _ in rows] + [(5000 + i, t, None) for i, t, _ in rows[:20]]
    scored = {r.doc_id: r.score for r in classifier.classify(documents(spark, moved), label_frame(spark, marks)).collect()}
    assert all(scored[5000 + i] == scored[i] for i, _, _ in rows[:20])


def test_classifier_bears_messy_rows(spark):
    rows, marks = labelled(spark)
    marks += [(None, 1), (0, None), (1, 0), (1, 1), (99_999, 1)]
    mixed = rows + messy()
    found = classifier.classify(documents(spark, mixed), label_frame(spark, marks)).collect()
    assert len(found) == len(mixed) and all(0 <= r.score <= 1 for r in found)
    none = label_frame(spark, [])
    assert {r.score for r in classifier.classify(documents(spark, mixed), none).collect()} == {0.5}
    only_good = classifier.classify(documents(spark, mixed), label_frame(spark, [(i, 1) for i, _, _ in rows]))
    assert {r.predicted for r in only_good.collect()} == {1}
    assert classifier.classify(documents(spark, []), label_frame(spark, marks)).count() == 0


def test_normal_equations_equal_a_fit_in_one_piece(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, len(classifier.STATISTICS)))
    y = (x[:, 0] > 0).astype(float)
    rows = spark.createDataFrame([(r.tolist(), float(t), int(i % 4) + 1) for i, (r, t) in enumerate(zip(x, y))], "x array<double>, y double, fold int")
    model = classifier.fit(rows.repartition(7), features=40)
    made = classifier.FourierMap(x.mean(axis=0), x.std(axis=0), 40, math.sqrt(x.shape[1]))(x)
    held = np.full(41, classifier.RIDGE * 300)
    held[-1] = 1e-9
    assert np.allclose(model["weights"], np.linalg.solve(made.T @ made + np.diag(held), made.T @ y), atol=1e-8)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((20, 6))
    made = classifier.FourierMap(np.zeros(6), np.ones(6), 20_000, 2.0)(x)[:, :-1]
    apart = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(made @ made.T - np.exp(-apart / 8)).max() < 0.05


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 8), st.integers(1, 8)), min_size=1, max_size=12))
def test_pooling_is_the_closest_monotone_fit(rows):
    """Compared with the max-min formula of isotonic regression."""
    counts = np.array([n for _, n in rows], float)
    labels = np.array([min(y, n) for y, n in rows], float)
    values = np.arange(len(rows), dtype=float)
    at, level = classifier.pooled(values, labels, counts)
    assert np.all(np.diff(level) > 0)
    total, weight = np.concatenate([[0], np.cumsum(labels)]), np.concatenate([[0], np.cumsum(counts)])

    def mean(a, b):
        return (total[b + 1] - total[a]) / (weight[b + 1] - weight[a])

    want = [max(min(mean(a, b) for b in range(i, len(rows))) for a in range(i + 1)) for i in range(len(rows))]
    assert np.allclose(sorted(set(np.round(want, 9))), np.round(level, 9))
