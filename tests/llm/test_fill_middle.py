"""Fill-in-the-middle: plain Python, the query's SQL and exact round trips."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest

from checks import compare
from loadloom.llm import fill_middle, queries

from .conftest import ODD

MARKED = [(20, "a\n<P>b\nc"), (21, "x <S> y"), (22, "<M>"), (23, "<P"), (24, "<\n<\nS>\nP>\n<S\n>"), (25, "\r\n\x0b\n \n\x85"), (26, "\n"), (27, "a\n\n\nb")]


def plain(doc_id, text, plan=fill_middle.Plan()):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{plan.salt}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= plan.fim_percent:
        return n, "plain", None, None, text
    if h[3] % 100 < plan.spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("plan", [fill_middle.Plan(), fill_middle.Plan("x", 60, 0), fill_middle.Plan("y", 100, 100)])
def test_outputs_equal_plain_python_and_restore(docs, plan):
    data = ODD + MARKED + [(100 + i, "\n".join(f"é{k}" for k in range(i % 7)) + "\n" * (i % 3)) for i in range(80)]
    found = fill_middle.restore(fill_middle.transform(docs(data), plan=plan)).collect()
    want = sorted([(d, *plain(d, t, plan), t or "") for d, t in data], key=repr)
    assert sorted([(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in found], key=repr) == want


def test_query_equals_its_sql(spark, small):
    got = queries.op12_fill_middle(spark, small).toPandas()
    assert compare.differences(got, compare.connect(small).execute(queries.ORACLES["op12_fill_middle"]).df()) is None
    assert set(got.form) == {"psm", "spm"} and (got.n > 0).all()


def test_empty_table_and_long_texts(docs):
    assert fill_middle.digests(docs([])).count() == 0
    long = [(i, ("line of text\n" * 200_000)[: 2_000_000 + i]) for i in range(20)]
    found = {r.doc_id: r for r in fill_middle.digests(docs(long)).collect()}
    for d, t in long:
        assert found[d].restored_sha256 == hashlib.sha256(t.encode()).hexdigest() and found[d].n == len(t.splitlines())


def test_slices_of_batches():
    texts = pa.array(["dropped\n", "a\nb\nc\n", "", "x", "\n\n"]).slice(1)
    lines, parent, ordinal = fill_middle.units(texts)
    assert lines.to_pylist() == ["a\n", "b\n", "c\n", "x", "\n", "\n"]
    assert parent.tolist() == [0, 0, 0, 2, 3, 3] and ordinal.tolist() == [0, 1, 2, 0, 0, 1]
    n, form, _, _, out = fill_middle.transformed(texts, np.arange(16, dtype=np.int64).reshape(4, 4))
    assert fill_middle.restored(out, form).to_pylist() == texts.to_pylist()
