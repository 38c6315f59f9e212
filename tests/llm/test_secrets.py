import hashlib
import re
import time

import pytest

from helixframe.llm import queries, secrets

KEY = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    text = text or ""
    found = [("assign", m) for m in KEY.finditer(text) if len(m[2]) >= 8]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    order = ["assign", "access", "hex"]
    spans = sorted((m.start(), order.index(k), m.end()) for k, m in found)
    return [sum(k == x for x, _ in found) for k in order], ",".join(f"{order[k]}:{a}:{b}" for a, k, b in spans)


def test_contract_on_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op2_secret_scans(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    seen = 0
    for d in docs:
        counts, base = brute(d.text)
        r = rows[d.doc_id]
        assert [r.n_assign, r.n_access, r.n_hex] == counts
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
        assert set(filter(None, base.split(","))) <= set(r.spans.split(","))
        seen += bool(base)
    assert seen > 5


@pytest.mark.parametrize("text", ["api_key = 'AbCdEf12' PASSWD:\"short\" token:=x", "toKen: secret=abcdefgh12", "toKen = abcdefgh", "AKIA" + "AB12" * 3 + " AKIAAKIAAKIAAKIA1", "0" * 31 + "g" + "a" * 33, "😀 password=😀 secret = zzzzzzzz"])
def test_base_spans(text):
    got = secrets.base_spans(text)
    assert ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b, _ in got) == brute(text)[1]


@pytest.fixture(scope="module")
def corpus(spark):
    own, shared = "ghp_q1w2e3r4t5y6u7i8o9p0", "ghp_a9s8d7f6g5h4j3k2l1z0"
    rows = [(i, f"see {shared} in the manual", f"src{i}", 0) for i in range(6)] + [(10, f"x {own} y {shared}", "src1", 5), (11, f"again {own}", "src1", 6), (12, "token=abcdefgh99", None, 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long"), own, shared


def test_ownership_separates_examples_from_live_ones(corpus):
    docs, own, _ = corpus
    rows = {r.doc_id: [tuple(s)[:3] for s in r.spans] for r in secrets.scan(docs).collect()}
    assert rows[0] == [] and rows[10] == [(2, 5, 2 + len(own))] and rows[11] == [(6, 5, 6 + len(own))]
    assert rows[12] == [(0, 0, 16)]


def test_many_repositories_of_one_owner_are_an_example(spark):
    rows = [(i, "token=pasted0everywhere", "one") for i in range(secrets.FEW_REPOSITORIES + 1)] + [(100 + i, "token=few0places", "one") for i in range(secrets.FEW_REPOSITORIES)]
    rows += [(100, "token=few0places", "one")] * 3  # a repeated row is no further repository
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {(r.doc_id < 100, r.live, r.copied) for r in secrets.scan(docs).collect()}
    assert got == {(True, 0, 1), (False, 1, 0)}


def test_masking(corpus):
    docs, own, shared = corpus
    masked = secrets.mask_live(docs)
    assert masked.columns == docs.columns and masked.dtypes == docs.dtypes
    rows = {r.doc_id: r for r in masked.collect()}
    assert rows[10].text == f"x [prefixed removed] y {shared}" and rows[10].n_chars == len(rows[10].text)
    assert rows[0].text.count(shared) == 1 and rows[12].text == "token=[assign removed]" and rows[3].n_chars == 0


@pytest.mark.parametrize("which", ["odd", "none"])
def test_odd_rows(which, request):
    docs = request.getfixturevalue(which)
    assert sorted(str(r.doc_id) for r in secrets.scan(docs).collect()) == sorted(str(r.doc_id) for r in docs.collect())
    masked = secrets.mask_live(docs)
    assert masked.columns == docs.columns
    before, after = (sorted(map(str, (r.doc_id for r in f.collect()))) for f in (docs, masked))
    assert before == after


def test_long_runs_take_linear_time():
    old = re.compile(r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", re.ASCII)
    for text in ("eyJ" * 5, "eyJabcdefgh.abcdefgh.abcdefgh.abcdefghi", "eyJa.eyJabcdefghi.abcdefgh.12345678 eyJabcdefgh.eyJabcdefgh.eyJabcdefgh.x", "xeyJabcdefgh.1234567.eyJabcdefgh.12345678.12345678"):
        assert list(secrets.bearer_spans(text)) == [m.span() for m in old.finditer(text)]
    began = time.perf_counter()
    for part in ("eyJ", "eyJ.", "eyJabcdefgh.", "a", "=", " ", ".", "sk-", "-----BEGIN ", "password ", "AKIA", "Ab0+/"):
        text = part * (5_000_000 // len(part))
        base = secrets.base_spans(text)
        secrets.further_spans(text, base)
    assert time.perf_counter() - began < 30


def test_many_spans_are_told_apart_once():
    text = " ".join(f"token=abcdefgh{i:05d} ghp_q1w2e3r4t5y6u7i8{i:05d}" for i in range(40_000))
    base = secrets.base_spans(text)
    began = time.perf_counter()
    found = secrets.further_spans(text, base)
    assert len(base) == 40_000 and len(found) == 40_000 and time.perf_counter() - began < 5
