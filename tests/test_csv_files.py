"""CSV through Spark's reader: encodings, layouts, headers below other lines, rejects, odd files."""

from tallymark.config import Settings
from tallymark.operators.posts import posts_from_chunks
from tallymark.sources import csv_files
from tallymark.sources.csv_files import posts_from_csv_folder, read_csv_folder
from tallymark.sources.files import decode_chunks

HEADER = "Post title,Post link,Created date,Impressions,Clicks\n"


def test_a_mixed_folder(spark, tmp_path):
    put = lambda name, content: (tmp_path / name).write_bytes(content)
    put("a.csv", (HEADER + '"A, ""one"" é",https://x/1,08/06/2025,100,5\nshort,https://x/2\n\n,,,,\n').encode())
    put("b.csv", (HEADER + '"two\nlines",https://x/3,,7,1\n').encode("utf-8-sig"))
    put("c.csv", (HEADER + "ünï 梦,https://x/4,,8,2\n").encode("utf-16"))
    put("d.csv", (HEADER + "café – €,https://x/5,,9,3\n").encode("cp1252"))
    put("e.dat", ("Report of March\n\n" + "Clicks,Impressions,Post link,Post title\n4,11,https://x/6,below lines\n").encode())
    put("f.csv", (HEADER + "too,many,,1,2,three\ntrailing,https://x/7,,1,2,,\n").encode())
    put("g.csv", b"PK\x03\x04 not text\n")
    put("h.csv", b"\x00\x01,\x02\n")
    put("i.csv", b"")
    put("j.csv", (HEADER + 'fine,https://x/8,,1,1\n"left open,https://x/9,,1,1\n').encode())
    found = read_csv_folder(spark, f"file://{tmp_path}", Settings())
    posts = {r.post_title: (r.impressions, r.clicks, r.post_url) for r in posts_from_csv_folder(found, Settings()).collect()}
    assert posts == {
        'A, "one" é': (100, 5, "https://x/1"), "short": (0, 0, "https://x/2"), "two\nlines": (7, 1, "https://x/3"),
        "ünï 梦": (8, 2, "https://x/4"), "café – €": (9, 3, "https://x/5"), "below lines": (11, 4, "https://x/6"),
        "trailing": (1, 2, "https://x/7"), "fine": (1, 1, "https://x/8"),
    }
    rejects = {(r.path.rsplit("/", 1)[1], r.reason): r.record for r in found.rejects.collect()}
    assert rejects[("f.csv", "more cells than the header")] == "too,many,,1,2,three"
    assert ("g.csv", "an archive or workbook") in rejects and ("h.csv", "control characters: this is no text") in rejects
    assert rejects[("j.csv", "a quote is left open")].startswith('"left open') and len(rejects) == 4


def test_the_same_as_file_by_file(spark, tmp_path):
    for n in range(3):
        (tmp_path / f"{n}.csv").write_text(HEADER + "".join(f'"t{n} {i}, ""q""",https://x/{n}-{i},,{i},{i % 7}\n' for i in range(300)))
    found = read_csv_folder(spark, f"file://{tmp_path}", Settings())
    assert len(found.tables) == 1 and found.rejects.isEmpty()
    files = spark.read.format("binaryFile").load(f"file://{tmp_path}")
    columns = ["post_id", "post_title", "impressions", "clicks", "post_type", "source_file", "ctr"]
    ours = posts_from_csv_folder(found, Settings()).select(*columns)
    assert "Python" not in ours._jdf.queryExecution().toString() and "InArrow" not in ours._jdf.queryExecution().toString()
    assert sorted(ours.collect()) == sorted(posts_from_chunks(decode_chunks(files), Settings()).select(*columns).collect())


def test_no_files(spark, tmp_path):
    (tmp_path / "only.bin").write_bytes(b"\x00\x01")
    found = read_csv_folder(spark, f"file://{tmp_path}", Settings())
    assert found.tables == [] and posts_from_csv_folder(found, Settings()) is None and found.rejects.count() == 1


def test_a_cell_with_thousands_of_commas_widens_nothing(spark, tmp_path, monkeypatch):
    """Only the first records of a file are cut into as many cells as they may have."""
    widths, read = [], csv_files._read
    monkeypatch.setattr(csv_files, "_read", lambda spark, paths, names, *more: widths.append(len(names)) or read(spark, paths, names, *more))
    long = "a," * 3000 + "\nb"
    rows = "".join(f'post {n},https://x/{n},,{n},1\n' for n in range(20))
    (tmp_path / "a.csv").write_text("\n" + HEADER + f'5" disk,https://x/d,,7,"1"\n{rows}"{long}",https://x/long,,8,1\n', newline="")
    (tmp_path / "b.csv").write_text("Notes of\r\n" + HEADER.replace("\n", "\r\n") + f'"{long}",https://x/first,,9,1\r\n"q ""r"", s",https://x/q,,10,1\r\n', newline="")
    (tmp_path / "c.csv").write_text('"Post\ntitle","Post link","Impressions"\n"two, three",https://x/c,11\n', newline="")
    found = read_csv_folder(spark, f"file://{tmp_path}", Settings())
    assert max(widths) == 5
    told = {r.path.rsplit("/", 1)[1]: (r.header_row, r.names) for r in found.files.collect()}
    names = HEADER.strip().split(",")
    assert told == {"a.csv": (0, names), "b.csv": (1, names), "c.csv": (0, ["Post\ntitle", "Post link", "Impressions"])}
    posts = {r.post_url: r.impressions for r in posts_from_csv_folder(found, Settings()).collect()}
    assert posts == {f"https://x/{n}": n for n in range(20)} | {"https://x/d": 7, "https://x/long": 8, "https://x/first": 9, "https://x/q": 10, "https://x/c": 11}
