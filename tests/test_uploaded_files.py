"""Contents of uploads: names and digests as a replay gives them, and nothing but them through a shuffle."""

import hashlib
import os

from inkwell.operators.uploads import store_uploaded_files, upload_screen
from inkwell.sources.uploads import scan_uploaded_files

# (folder, name, contents, second of arrival)
FILES = [
    ("a", "notes.txt", b"first", 10),
    ("b", "notes.txt", b"second", 20),
    ("c", "no tes.txt", b"other name", 5),
    ("d", "My  Photo(1).PNG", b"\x00\xff" * 50_000, 7),
    ("e", "script.sh", b"refused", 9),
    ("f", "noext", b"refused", 9),
    ("g", "empty.pdf", b"", 11),
    ("h", "50%+1.txt", b"signs", 12),
    ("i", "notes.TXT", b"another case", 30),
]


def upload(folder):
    for name, fn, data, second in FILES:
        place = folder / name
        place.mkdir()
        (place / fn).write_bytes(data)
        os.utime(place / fn, (second, second))


def test_contents_of_uploads(spark, tmp_path):
    upload(tmp_path)
    screened = upload_screen(scan_uploaded_files(spark, str(tmp_path)))
    assert sorted((r.fn, r.outcome == "ok") for r in screened.collect()) == sorted(
        (fn, fn not in ("script.sh", "noext")) for _, fn, data, _ in FILES if data
    )
    stored = {r.clean: (r.fn, r.n_bytes, r.digest) for r in store_uploaded_files(screened).collect()}
    assert len(stored) == 5
    assert stored["notes.txt"] == ("notes.txt", 6, hashlib.sha256(b"second").hexdigest())
    by_name = {fn: data for _, fn, data, _ in sorted(FILES, key=lambda f: f[3])}
    for fn, n_bytes, digest in stored.values():
        assert (n_bytes, digest) == (len(by_name[fn]), hashlib.sha256(by_name[fn]).hexdigest())


def test_no_content_is_shuffled(spark, tmp_path):
    upload(tmp_path)
    stored = store_uploaded_files(upload_screen(scan_uploaded_files(spark, str(tmp_path))))
    lines = stored._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert not any("content" in line for line in lines[: exchange + 1])
    assert any("content" in line for line in lines[exchange:])


def test_no_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert store_uploaded_files(upload_screen(scan_uploaded_files(spark, str(tmp_path)))).isEmpty()
