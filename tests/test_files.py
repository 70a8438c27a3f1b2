"""Readers on small generated files."""

import json
import tracemalloc
from datetime import datetime
from email.policy import EmailPolicy

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.config import Settings
from tallymark.operators import demographics, maintenance, posts, reports
from tallymark.plans.workbooks import archive_bytes, workbook_bytes
from tallymark.sources import decode, files, mail
from tallymark.sources.snapshots import read_snapshots, snapshot_metrics, snapshot_posts

HEADER = "Post title,Post link,Content Type,Created date,Impressions,Clicks\n"


def write(folder, **contents):
    for name, content in contents.items():
        (folder / name.replace("__", ".")).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def records(spark, folder, settings, manual=False):
    chunks = files.read_chunks(spark, str(folder), manual)
    return {r.post_title: r for r in posts.posts_from_chunks(chunks, settings).collect()}


def test_csv_with_quotes_blank_rows_and_uneven_rows(spark, tmp_path, settings):
    write(tmp_path, p__csv=(
        " Post title ,Post link,Impressions,Clicks,Clicks\n"
        '"a, ""quoted""\nline",https://x/1,"1,000",5,9\n\n'
        "short,https://x/2\n"
        ",https://x/3,1,1,1\n"
        "long,https://x/4,7,1,1,extra,more\n"
        "NA,https://x/5,7,1,1\n"
    ))
    found = records(spark, tmp_path, settings)
    assert set(found) == {'a, "quoted"\nline', "short", "long"}
    first = found['a, "quoted"\nline']
    assert (first.impressions, first.clicks, first.ctr) == (1000, 5, 0.5)
    assert found["short"].impressions == 0 and found["short"].engagement_rate == 0.0
    assert found["long"].impressions == 7


@pytest.mark.parametrize("encoding", ["utf-8", "utf-8-sig", "cp1252", "utf-16"])
def test_encodings(spark, tmp_path, settings, encoding):
    write(tmp_path, p__csv=(HEADER + "Été à Łódź #é,u,,,5,1\n" if "utf" in encoding else HEADER + "Été – “x” #é,u,,,5,1\n").encode(encoding))
    row = next(iter(records(spark, tmp_path, settings).values()))
    assert row.hashtags == ["#é"] and row.post_title.startswith("Été") and "�" not in row.post_title


def test_bytes_undefined_in_cp1252_fall_to_latin1(spark, tmp_path):
    write(tmp_path, p__csv=HEADER.encode() + b"caf\xe9 \x81,u,,,5,1\n")
    assert files.read_chunks(spark, str(tmp_path)).first().encoding == "latin-1"
    assert files.read_chunks(spark, str(tmp_path), manual=True).first().encoding == "latin-1"


def test_older_profile_prefers_latin1(spark, tmp_path):
    write(tmp_path, p__csv=HEADER.encode() + b"caf\xe9 \x93,u,,,5,1\n")
    assert files.read_chunks(spark, str(tmp_path)).first().encoding == "cp1252"
    assert files.read_chunks(spark, str(tmp_path), manual=True).first().encoding == "latin-1"


SHEET = [
    ["Post title", "Post link", "Created date", "Impressions", "Clicks", "Click through rate (CTR)", "Engagement rate"],
    ["one", "https://x/1", datetime(2025, 8, 6, 14, 30), 1234.0, 5, 0.0036, 0.02],
    [None, None, None, None, None],
    ["two", None, "13/06/2025", "1,000", -5, "0.5%", None],
    ["big", None, "2025-08-06", 1e16, 1, None, None],
]


@pytest.mark.parametrize("inline", [False, True])
def test_workbook(spark, tmp_path, settings, inline):
    sheets = [("Summary", [["Title"], ["wrong"]]), ("All Posts", SHEET)]
    write(tmp_path, content__xlsx=workbook_bytes(sheets, inline))
    found = records(spark, tmp_path, settings)
    assert set(found) == {"one", "two", "big"}
    assert found["one"].post_date == datetime(2025, 8, 6, 14, 30)
    assert (found["one"].impressions, found["one"].ctr) == (1234, 0.36)
    assert found["two"].clicks == 5 and found["two"].impressions == 1000 and found["two"].ctr == 0.5
    assert found["two"].post_date == datetime(2025, 6, 13)
    assert found["big"].impressions == 10**16


def test_first_sheet_without_posts_sheet(spark, tmp_path, settings):
    write(tmp_path, content__xlsx=workbook_bytes([("A", SHEET), ("B", [["Title"], ["wrong"]])]))
    assert "one" in records(spark, tmp_path, settings)


def test_workbook_that_is_csv_and_archives(spark, tmp_path, settings):
    write(
        tmp_path,
        fake__xlsx=HEADER + "from fake,u1,,,5,1\n",
        broken__xlsx=b"PK\x03\x04 no archive, yet text\n",
        pack__zip=archive_bytes({"a.csv": "Title\nwrong\n", "my_POSTS.csv": HEADER + "from zip,u2,,,5,1\n"}),
        first__zip=archive_bytes({"z.csv": HEADER + "first member,u3,,,5,1\n", "b.csv": "Title\nwrong\n"}),
        nested__zip=archive_bytes({"posts.xlsx": workbook_bytes([("s", SHEET)])}),
        nothing__zip=archive_bytes({"readme.txt": "hello"}),
        bad__zip=b"no archive",
        empty__csv=b"\n\n",
        none__csv=b"",  # Spark hands out no file without bytes
        old__xls=b"\xd0\xcf\x11\xe0 old",
    )
    assert {"from fake", "from zip", "first member", "one", "two", "big"} == set(records(spark, tmp_path, settings))
    ledger = maintenance.ledger_rows(files.read_chunks(spark, str(tmp_path)), settings, "b")
    states = {r.file_name: r.status for r in ledger.collect()}
    assert states == {
        "fake.xlsx": "ok", "broken.xlsx": "unreadable", "pack.zip": "ok", "first.zip": "ok", "nested.zip": "ok",
        "nothing.zip": "empty", "bad.zip": "unreadable", "empty.csv": "empty", "old.xls": "unsupported",
    }


@pytest.mark.parametrize("lead", ["", "Page report\n", "Page report\nmade today\n\nfor you\n"])
def test_header_below_other_lines(spark, tmp_path, settings, lead):
    write(tmp_path, p__csv=lead + HEADER + "hello,u,Image,08/06/2025,10,1\n")
    row = records(spark, tmp_path, settings)["hello"]
    assert (row.impressions, row.post_type, row.post_date) == (10, "image", datetime(2025, 8, 6))


def test_many_chunks_keep_row_order(spark, tmp_path, settings):
    lines = "".join(f"t{i},https://x/same,,,{i},1\n" for i in range(95))
    write(tmp_path, p__csv="Report\n" + HEADER + lines)
    binary = spark.read.format("binaryFile").load(str(tmp_path))
    chunks = files.decode_chunks(binary, chunk_rows=7)
    assert chunks.count() == 14
    rows = posts.posts_from_chunks(chunks, settings).orderBy("arrival").collect()
    assert [r.post_title for r in rows] == [f"t{i}" for i in range(95)]


def test_the_cells_of_a_file_are_never_held_together():
    text = (HEADER + "".join(f"post {n},https://x/{n},,,{n},1\n" for n in range(20_000))).encode()
    tracemalloc.start()
    rows = [len(chunk["rows"]) for chunk in decode.chunk_records("a.csv", None, text, ["utf-8"], 2000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == [2000] * 10 + [1] and peak < 8 * len(text)


def test_views_stand_in_for_impressions(spark, tmp_path, settings):
    write(tmp_path, p__csv="Title,Impressions,Views,Clicks,Engagement rate\na,0,50,5,\nb,10,50,5,\nc,0,0,1,0.25\nd,0,0,1,250%\n")
    found = records(spark, tmp_path, settings)
    assert [found[k].impressions for k in "abcd"] == [50, 10, 0, 0]
    assert [found[k].engagement_rate for k in "abcd"] == [10.0, 50.0, 25.0, 100.0]


def test_demographics(spark, tmp_path, settings):
    sheets = [
        ("Location", [["Location", "Total followers", "%"], ["Lagos", 12, 150.0], ["Accra", 0, 0.25], ["Kano", 0, 0], [None, 5, 1]]),
        ("Job seniority", [["x", "y"], ["v" * 300, 3]]),
        ("Odd Name", [["Name", "Count"], ["a", "1,2"]]),
    ]
    write(tmp_path, followers__xlsx=workbook_bytes(sheets), demographic__csv="Location,Members\nLagos,3\n")
    chunks = files.read_chunks(spark, str(tmp_path))
    known = spark.createDataFrame([("company", 77), ("other", 5)], "company_id string, followers bigint")
    rows = demographics.demographics_from_chunks(chunks, settings, known).collect()
    found = {(r.demographic_type, r.demographic_value): (r["count"], r.percentage) for r in rows}
    assert found == {
        ("location", "Lagos"): (12, 100.0), ("location", "Accra"): (0, 0.25), ("job_function", "v" * 255): (3, 0.0),
        ("odd_name", "a"): (12, 0.0), ("demographics", "Lagos"): (3, 0.0),
    }
    assert {r.total_followers for r in rows} == {77} and {r.date_collected for r in rows} == {datetime(2025, 9, 1)}
    as_rate = Settings(as_of=settings.as_of, demographic_as_rate=True)
    accra = demographics.demographics_from_chunks(chunks, as_rate).where("demographic_value = 'Accra'").first()
    assert accra.percentage == 25.0 and accra.total_followers == 0
    older = Settings(as_of=settings.as_of, profile="manual")
    rows = demographics.demographics_from_chunks(chunks, older).collect()
    assert {r.demographic_value for r in rows} == {"Lagos", "v" * 255, "a"} and rows[0].total_followers == 1000


def test_large_csv(spark, tmp_path, settings):
    big, other = tmp_path / "big", tmp_path / "other"
    big.mkdir(), other.mkdir()
    write(big, a__csv=HEADER + '"two\nlines",u1,,08/06/2025,"1,000",5\nNA,u2,,,1,1\n', b__csv=HEADER + "b,u3,,,2,1\n")
    rows = files.read_large_csv(spark, str(big))
    found = posts.posts_from_table(rows, settings).orderBy("arrival").collect()
    assert [(r.post_title, r.impressions, r.source_file) for r in found] == [("two\nlines", 1000, "a.csv"), ("b", 2, "b.csv")]
    layout = {r.path.split("/")[-1]: (r.line_breaks_in_cells, r.utf8) for r in files.line_breaks_in_cells(spark, str(big)).collect()}
    assert layout == {"a.csv": (True, True), "b.csv": (False, True)}
    write(other, c__csv=b"Title,Clicks\nx\xff,1\n")
    assert files.line_breaks_in_cells(spark, str(other)).first().utf8 is False
    with pytest.raises(Exception, match="(?i)header"):
        files.read_large_csv(spark, [str(big / "a.csv"), str(other / "c.csv")]).collect()


def test_ambiguous_dates_from_files(spark, tmp_path, settings):
    write(tmp_path, p__csv=(
        "Post title,Link,Created date,Campaign start date\n"
        "a,u1,08/06/2025,2025-08-01\nb,u2,08/06/2025,\nc,u3,13/06/2025,\nd,u4,,\ne,u5,08/06/2025,10/06/2025\n"
    ))
    rows = reports.ambiguous_dates_from_chunks(files.read_chunks(spark, str(tmp_path)), settings).collect()
    assert {(r.post_url, r.chosen) for r in rows} == {("u1", "mdy"), ("u2", "dmy"), ("u5", "dmy")}


def test_profile(spark, tmp_path, settings):
    write(tmp_path, p__csv="note\n" + HEADER + "a,u,,,1,1\nb,u,,,1,1\n")
    row = reports.file_profile(files.read_chunks(spark, str(tmp_path)), settings).first()
    assert (row.header_row, row.data_rows, row.encoding) == (1, 2, "utf-8")
    assert row["names"][0] == "Post title" and [s[0] for s in row.sample] == ["a", "b"]


MESSAGE = """Subject: =?utf-8?q?Weekly_update_=E2=9C=93?=
From: Page <news@linkedin.example>
Date: Mon, 1 Sep 2025 10:00:00 +0000
MIME-Version: 1.0
Content-Type: multipart/{kind}; boundary="b"

--b
Content-Type: text/plain; charset=utf-8

12 followers
{rest}--b--
"""
ATTACHMENT = """--b
Content-Type: text/csv
Content-Disposition: attachment; filename="x\\\\my/posts.CSV"

Title,Clicks
hello,1
--b
Content-Type: text/plain
Content-Disposition: attachment; filename="notes.txt"

no
"""


def test_messages(spark, tmp_path, settings):
    write(
        tmp_path,
        digest__eml=MESSAGE.format(kind="alternative", rest="--b\nContent-Type: text/html\n\n<b>99</b> followers\n"),
        attached__eml=MESSAGE.format(kind="mixed", rest=ATTACHMENT).replace("Weekly_update", "Content_export"),
        single__eml="Subject: Your page\nFrom: a@linkedin.example\nContent-Type: text/html; charset=latin-1\n\nFollowers: 7 caf\xe9",
        other__eml="Subject: Your page\nFrom: a@mail.example\n\n7 followers",
    )
    messages = mail.decode_messages(spark.read.format("binaryFile").load(str(tmp_path)))
    rows = {r.path.split("/")[-1]: r for r in mail.digests(messages).collect()}
    assert set(rows) == {"digest.eml", "single.eml"}
    assert rows["digest.eml"].subject == "Weekly update ✓" and rows["digest.eml"].body.startswith("12 followers")
    attached = mail.attached_files(messages).collect()
    assert [a.path.split("/")[-1] for a in attached] == ["x_my_posts.CSV"]
    decoded = files.decode_chunks(mail.attached_files(messages))
    assert posts.posts_from_chunks(decoded, settings).first().post_title == "hello"


def test_odd_mails_cost_only_what_is_odd(spark, tmp_path):
    write(
        tmp_path,
        raw__eml=b"Subject: page update caf\xe9 \xff\nFrom: a@linkedin.example\nDate: \xe9t\xe9\n\n5 followers",
        charset__eml=b"Subject: =?x-none?q?page_update?=\nFrom: a@linkedin.example\nContent-Type: text/plain; charset=x-none\n\n6 followers",
        nothing__eml=b"",
        noise__eml=bytes(range(256)) * 20,
        good__eml=b"Subject: Page update\nFrom: a@linkedin.example\n\n7 followers",
    )
    rows = {r.path.split("/")[-1]: r for r in mail.decode_messages(spark.read.format("binaryFile").load(str(tmp_path))).collect()}
    assert len(rows) == 4, "Spark hands out no files without bytes"
    assert rows["good.eml"].body == "7 followers" and rows["charset.eml"].body == "6 followers" and "5 followers" in rows["raw.eml"].body
    assert "page update" in rows["raw.eml"].subject


def test_equal_headers_are_parsed_once(monkeypatch):
    """And mails are handed on together."""
    parsed = []
    kept = EmailPolicy.header_fetch_parse
    monkeypatch.setattr(EmailPolicy, "header_fetch_parse", lambda self, name, value: parsed.append(name) or kept(self, name, value))
    text = MESSAGE.format(kind="mixed", rest=ATTACHMENT).encode()
    found = []

    class Files:
        def select(self, *columns):
            return self

        def mapInArrow(self, decode, schema):
            batch = pa.RecordBatch.from_pydict({"path": [f"m{i}" for i in range(300)], "content": [text.replace(b"12 f", b"%d f" % i) for i in range(300)]})
            found.extend(decode(iter([batch, batch])))

    mail.decode_messages(Files())
    rows = [r for b in found for r in b.to_pylist()]
    assert len(found) == 1 and len(rows) == 600 and len(parsed) < 50
    assert [r["body"].split()[0] for r in rows[:300]] == [str(i) for i in range(300)]
    assert {(r["subject"], r["from"], tuple(a["name"] for a in r["attachments"])) for r in rows} == {
        ("Weekly update ✓", "Page <news@linkedin.example>", ("x\\my/posts.CSV", "notes.txt"))
    }


def test_snapshots(spark, tmp_path):
    for i, clicks in enumerate((122, 0)):
        content = {
            "timestamp": f"20250810_1{i}4809", "total_posts": 1,
            "company_metrics": {"followers_count": 10 + i, "impressions": 5}, "posts": [{"post_id": "p", "clicks": clicks, "hashtags": ["#a"]}],
        }
        (tmp_path / f"s{i}.json").write_text(json.dumps(content, indent=2))
    snapshots = read_snapshots(spark, str(tmp_path))
    assert [r.clicks for r in snapshot_posts(snapshots).orderBy("taken_at").collect()] == [122, 0]
    metrics = snapshot_metrics(snapshots).orderBy("taken_at").collect()
    assert [r.followers_count for r in metrics] == [10, 11] and metrics[0].taken_at == datetime(2025, 8, 10, 10, 48, 9)


def test_names(spark):
    names = ["LinkedIn_page.CSV", "my_posts_followers.xlsx", "Audience.xls", "x.csv.part", "notes.pdf", "~overview.csv", "company demographics.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    n = F.col("n")
    rows = df.select(
        files.file_route(n).alias("route"), files.file_route(n, True).alias("older"), files.is_export_name(n).alias("taken"),
        files.is_export_name(n, True).alias("older_taken"), files.is_download(n).alias("download"),
    ).collect()
    assert [r.route for r in rows] == ["posts", "posts", "demographics", "posts", "posts", "posts", "demographics"]
    assert [r.older for r in rows] == ["posts", "posts", "demographics", "posts", "posts", "posts", "posts"]
    assert [r.taken for r in rows] == [True, True, True, False, False, True, True]
    assert [r.older_taken for r in rows] == [False, True, True, False, False, False, True]
    assert [r.download for r in rows] == [True, True, False, False, False, False, True]
