"""Merkle manifest, packaged archives and infilling against plain versions, on nulls, empty and long
texts, ties, repeated rows, rows without an id, empty tables and clashing columns."""

import hashlib
import io
import json
import re
import zipfile
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from staytally.llm import fill_middle, merkle, warc
from staytally.llm.queries import QUERIES

RANDOM = np.random.default_rng(11)
UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")
ALPHABET = list("abXY \t\n\x0b\x0c\r\x08\x0e\x1f!\x7f<>PSM") + ["é", "漢", "😀", "\x85", "\xa0", "\x00"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def any_text(n):
    return "".join(RANDOM.choice(ALPHABET, n))


@pytest.fixture(scope="module")
def rows():
    texts = [any_text(int(n)) for n in RANDOM.integers(0, 60, 700)]
    texts[:9] = [None, "", " ", "\n\t ", "a<P>b", "<S>", "<M> x", "ABC " * 20_000, "word"]
    langs = ["en"] * 8 + ["de", None, "", "é"]
    out = [
        (i, t, langs[i % 12], f"s{i % 5}" if i % 6 else None, len(t or ""), "tree", i, "up")
        for i, t in enumerate(texts)
    ]
    out += [out[3]] * 3 + [(out[5][0], "another text of a used id", *out[5][2:])]
    out += [(None, t, "en", "s", 5, "tree", 1, "up") for t in ("x", "x", "y z", None)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long, tree string, rank int, up string"
    return spark.createDataFrame(rows, schema)


def _query(spark, name, tmp_path_factory, docs, table="documents"):
    folder = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{folder}/{table}.parquet")
    return QUERIES[name](spark, folder)


# --- Merkle manifest ---------------------------------------------------------------------


def _field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def _leaf(doc_id, text, lang, source, n_chars):
    return sha("".join(map(_field, (doc_id, source, lang, n_chars, text))))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        last = out[-1]
        out.append([sha("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return out


def _steps(levels, i):
    for nodes in levels[:-1]:
        run = i // 8 * 8
        yield "".join(nodes[run:i]), "".join(nodes[i + 1 : run + 8])
        i //= 8


def _plain_manifest(rows):
    trees = defaultdict(list)
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = checked = _leaf(doc_id, text, lang, source, n_chars)
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            low = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            checked = _leaf(doc_id, low, lang, source, n_chars)
        trees[lang].append((doc_id is not None, doc_id or 0, leaf, checked))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {lang: _levels([leaf for *_, leaf, _ in sorted(trees[lang])]) for lang in names}
    above = _levels([built[lang][-1][0] for lang in names])
    root, out = above[-1][0], Counter()
    for number, lang in enumerate(names):
        for i, (known, doc_id, leaf, checked) in enumerate(sorted(trees[lang])):
            steps = [*_steps(built[lang], i), *_steps(above, number)]
            folded = checked
            for before, after in steps:
                folded = sha(before + folded + after)
            proof = sha("".join(b + a for b, a in steps))
            doc_id = doc_id if known else None
            out[doc_id, leaf, built[lang][-1][0], root, proof, folded, folded == root] += 1
    return out


def _manifest_rows(frame):
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return Counter(tuple(r) for r in frame.select(columns).collect())


def test_manifest_equals_a_plain_tree(spark, docs, rows, tmp_path_factory):
    got = _manifest_rows(_query(spark, "op11_merkle_manifest", tmp_path_factory, docs))
    assert got == _plain_manifest(rows)


@pytest.mark.parametrize("levels", [1, 2])
def test_manifest_of_many_rounds(spark, docs, rows, tmp_path_factory, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    got = _manifest_rows(_query(spark, "op11_merkle_manifest", tmp_path_factory, docs))
    assert got == _plain_manifest(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_manifest_of_one_language(spark, docs, rows, n, tmp_path_factory):
    some = [(i, f"T{i}", "en", "s", 2, "tree", 1, "up") for i in range(n)]
    frame = spark.createDataFrame(some, docs.schema)
    got = _manifest_rows(_query(spark, "op11_merkle_manifest", tmp_path_factory, frame))
    assert got == (_plain_manifest(some) if n else Counter())


def test_proofs_verify_what_was_not_changed(docs):
    proven = merkle.manifest(docs)
    agreed = proven.where(merkle.fold(F.col("checked"), "proof") == F.col("root"))
    assert agreed.count() == docs.count() and proven.select("root").distinct().count() == 1
    assert {r.lang for r in proven.collect()} == {"en", "de", None, "", "é"}


# --- packaged archives -------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    long, again = "<p>é and so on</p>" * 30_000, "<html>" + "repeated page " * 30
    rows = [(i, f"http://x/{i}?q=a b", f"<p>{any_text(int(RANDOM.integers(300)))}</p>") for i in range(60)]
    rows += [(60 + i, "http://x/again\r\nX: y", again) for i in range(200)]
    rows += [(300, None, None), (301, "", ""), (302, "u", "x" * 100), (303, "u", "x" * 100)]
    rows += [(304, "u", "x" * 99), (305, "u", "x" * 99), (306, "u", long), (307, None, long)]
    rows += [(302, "u", "x" * 100), (20, "twice", again), (20, "twice", again)]
    rows += [(None, "n", again), (None, "n", "y" * 200), (None, "m", "y" * 200), (None, None, None)]
    schema = "page_id long, url string, html string, row int, digest string, lead string"
    return spark.createDataFrame([(*r, 1, "d", "l") for r in rows], schema)


def _plain_pages(pages):
    groups = defaultdict(list)
    for r in pages.collect():
        groups[r.html or ""].append(r.page_id)
    out = Counter()
    for html, ids in groups.items():
        data = html.encode()
        ids.sort(key=lambda i: (i is None, i))
        for number, page in enumerate(ids):
            again = number > 0 and len(data) >= 100
            kind = "revisit" if again else "response"
            out[page, len(data), hashlib.sha256(data).hexdigest(), kind, ids[0] if again else None] += 1
    return out


@pytest.mark.parametrize("wide", [False, True])
def test_archives_come_back(spark, pages, tmp_path, wide):
    packages = warc.write_archives(pages, str(tmp_path), package_bytes=20_000, wide=wide)
    found = warc.read_archives(packages, id_type="long", payloads=True)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert Counter(tuple(r) for r in found.select(columns).collect()) == _plain_pages(pages)
    bodies = Counter(bytes(r.payload).decode() for r in found.where("record_type = 'response'").collect())
    assert set(bodies) == {r.html or "" for r in pages.collect()}
    assert found.where("record_type = 'revisit' AND payload IS NOT NULL").isEmpty()
    assert packages.agg(F.sum("records")).first()[0] == pages.count() and packages.count() > 3
    listed = warc.packages_in(spark, str(tmp_path)).collect()
    assert {r.package.rsplit("/")[-1] for r in listed} == {r.package.rsplit("/")[-1] for r in packages.collect()}


def test_registered_query(spark, pages, tmp_path_factory):
    got = _query(spark, "op12_warc_packages", tmp_path_factory, pages, "pages")
    assert Counter(tuple(r) for r in got.collect()) == _plain_pages(pages)
    assert _query(spark, "op12_warc_packages", tmp_path_factory, pages.limit(0), "pages").count() == 0


@pytest.mark.parametrize("wide", [False, True])
def test_others_read_the_packages(spark, pages, tmp_path, wide):
    """The standard ZIP reader finds sound members, and gzip the records one after another."""
    packages = warc.write_archives(pages, str(tmp_path), wide=wide)
    records = 0
    for r in packages.collect():
        with zipfile.ZipFile(r.package) as package:
            assert package.testzip() is None
            assert {m.compress_type for m in package.infolist()} == {zipfile.ZIP_STORED}
            about = json.loads(package.read(warc.DESCRIPTION))
            for entry in about["resources"]:
                data = package.read(entry["path"])
                assert entry["hash"] == f"sha256:{hashlib.sha256(data).hexdigest()}" and entry["bytes"] == len(data)
            data = package.read(warc.ARCHIVE)
        while data:
            press = zlib.decompressobj(31)
            fields, _, _ = warc.parse(press.decompress(data))
            data, records = press.unused_data, records + 1
            assert "\n" not in fields["warc-target-uri"]
    assert records == pages.count()


def test_reads_packages_of_others():
    """A commented ZIP64 archive with a deflated member, a member before and a packed index."""
    parts = [warc._packed(warc.record("response", {"WARC-Target-URI": f"u{i}"}, {}, b"p%d" % i)) for i in range(3)]
    data = b"lead" + b"".join(parts)
    at, lines = 4, []
    for i, part in enumerate(parts):
        entry = {"offset": at, "length": len(part), "filename": "archive/a.warc.gz"}
        lines.append(f"u{i} 2026 {json.dumps(entry)}\n")
        at += len(part)
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w") as package:
        package.comment = b"a comment with PK\x05\x06 in it"
        package.writestr("readme.txt", "deflated" * 99, zipfile.ZIP_DEFLATED)
        with package.open("archive/a.warc.gz", "w", force_zip64=True) as member:
            member.write(data)
        package.writestr("indexes/i.cdx.gz", zlib.compress("".join(reversed(lines)).encode(), wbits=31))
    size = len(file.getvalue())
    assert [p for *_, p in warc.records_of(file, size)] == [b"p0", b"p1", b"p2"]
    assert "readme.txt" not in warc.members(file, size)


def test_a_changed_payload_is_refused(spark, tmp_path):
    page = spark.createDataFrame([(1, "u", "z" * 300)], "page_id long, url string, html string")
    package = warc.write_archives(page, str(tmp_path)).first().package
    with open(package, "r+b") as file:
        start, size = warc.members(file, len(open(package, "rb").read()))[warc.ARCHIVE]
        file.seek(start)
        raw = zlib.decompress(file.read(size), 31).replace(b"z" * 300, b"q" * 300)
        data = warc._packed(raw)
        assert len(data) == size
        file.seek(start)
        file.write(data)
    with pytest.raises(Exception, match="differs from its record"):
        warc.read_archives(spark.createDataFrame([(package,)], "package string")).collect()


# --- infilling ---------------------------------------------------------------------------


def _plain_infill(doc_id, text):
    text = text or ""
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    a, b = sorted(v % (len(units) + 1) for v in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infilling_equals_a_plain_version(docs, rows):
    got = fill_middle.fill_in_middle(docs)
    assert Counter(tuple(r) for r in got.collect()) == Counter(_plain_infill(r[0], r[1]) for r in rows)
    assert {r.form for r in got.collect()} == {"plain", "psm", "spm"}
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


def test_texts_are_rebuilt(spark, docs, rows, tmp_path_factory):
    got = _query(spark, "op13_fill_middle", tmp_path_factory, docs).collect()
    expected = [_plain_infill(r[0], r[1]) for r in rows]
    wanted = Counter((*e[:5], sha(e[5]), sha(r[1] or "")) for e, r in zip(expected, rows, strict=True))
    assert Counter(tuple(r) for r in got) == wanted


def test_cuts_in_blocks_of_words(monkeypatch):
    """Every length, offset and boundary of blocks, on random bytes of all widths."""
    monkeypatch.setattr(fill_middle, "_BLOCK", 3)
    for _ in range(200):
        texts = [any_text(int(n)) for n in RANDOM.integers(0, 40, RANDOM.integers(1, 9))]
        draws = RANDOM.integers(0, 2**32, (2, len(texts)))
        n, data, offsets, cuts, points = fill_middle.cut(pa.array(texts), *draws)
        for i, text in enumerate(texts):
            units = UNIT.findall(text)
            assert n[i] == len(units)
            for row, k in enumerate(sorted(int(v) % (len(units) + 1) for v in draws[:, i])):
                part = "".join(units[:k])
                assert bytes(data[offsets[i] : cuts[row, i]]).decode() == part
                assert points[row, i] == len(part)
