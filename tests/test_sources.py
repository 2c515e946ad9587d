"""CSV columns are bound by header name; files that lack one are rejected, not misread."""
import gzip

import pytest

from barlake.operators import cleanse
from barlake.session import checkpoint_root, scratch_path
from barlake.sources import readers
from barlake.streaming import ingest


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_any_column_order_and_rejects(spark, tmp_path):
    put(tmp_path, "a.csv", "Date,Symbol,Open,High,Low,Close,Volume\n2024-01-02,A,1,4,0.5,2,10\n")
    put(tmp_path, "b.csv", "Volume,Close,Note,Low,High,Open,Symbol,Date\n20,3,x,1,5,2,B,2024-01-03\n")
    put(tmp_path, "c.csv", "Date,Symbol,Open,High,Low,Close\n2024-01-04,C,1,1,1,1\n")
    put(tmp_path, "d.csv", "")
    rows = cleanse.clean_csv_bars(readers.read_bar_csv(spark, str(tmp_path))).orderBy("symbol").collect()
    assert [(r.symbol, r.open, r.high, r.low, r.close, r.volume) for r in rows] == [
        ("A", 1.0, 4.0, 0.5, 2.0, 10.0), ("B", 2.0, 5.0, 1.0, 3.0, 20.0)]
    rejects = readers.csv_rejects(spark, str(tmp_path))
    assert [(f.rsplit("/", 1)[-1], why) for f, why in rejects] == [("c.csv", "lacks or repeats Volume")]


def test_symbol_folders_of_different_orders(spark, tmp_path):
    put(tmp_path / "Symbol=A", "x.csv", "Date,Open,High,Low,Close,Volume\n2024-01-02,1,4,0.5,2,10\n")
    put(tmp_path / "Symbol=B", "x.csv", "Date,Close,High,Low,Open,Volume\n2024-01-02,99,100,1,5,10\n")
    rows = {r.symbol: (r.open, r.close) for r in cleanse.clean_csv_bars(
        readers.read_symbol_dirs(spark, str(tmp_path))).collect()}
    assert rows == {"A": (1.0, 2.0), "B": (5.0, 99.0)}


def test_no_usable_file_gives_no_rows(spark, tmp_path):
    put(tmp_path, "c.csv", "Date,Symbol\n2024-01-04,C\n")
    assert readers.read_bar_csv(spark, str(tmp_path)).count() == 0


def test_shared_folder_is_asked_for(spark):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Bare:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Bare())
    assert scratch_path(spark, "x", "/shared/area").startswith("/shared/area/barlake/x-")


def test_every_row_lands_in_a_cycle(spark, tmp_path):
    df = spark.createDataFrame([(None,), (-5,), (0,), (7,), (99,)], "offset bigint")
    for c in range(3):
        ingest.land_cycle(df, str(tmp_path / "x"), "offset", 4, c, 3)
    rows = {r.offset: r.cycle for r in spark.read.parquet(str(tmp_path / "x")).collect()}
    assert rows == {None: 0, -5: 0, 0: 0, 7: 1, 99: 2}


def test_damaged_bar_file_is_an_error(spark, tmp_path):
    rows = "".join(f"2024-01-02,S{i},1,4,0.5,{i % 97},10\n" for i in range(50000))
    packed = gzip.compress(("Date,Symbol,Open,High,Low,Close,Volume\n" + rows).encode())
    (tmp_path / "a.csv.gz").write_bytes(packed[:len(packed) // 2])
    with pytest.raises(Exception, match="a.csv.gz"):
        readers.read_bar_csv(spark, str(tmp_path)).collect()


def test_bar_file_gone_after_listing_is_an_error(spark, tmp_path):
    text = "Date,Symbol,Open,High,Low,Close,Volume\n2024-01-02,{},1,4,0.5,2,10\n"
    put(tmp_path, "a.csv", text.format("A"))
    put(tmp_path, "b.csv", text.format("B"))
    bars = readers.read_bar_csv(spark, str(tmp_path))
    (tmp_path / "b.csv").unlink()
    with pytest.raises(Exception):
        bars.collect()


def test_equal_unwanted_columns_are_read(spark, tmp_path):
    put(tmp_path, "a.csv", "Date,Symbol,Open,High,Low,Close,Volume,,\n2024-01-02,A,1,4,0.5,2,10,,\n")
    put(tmp_path, "b.csv", "Date,Symbol,Open,High,Low,Close,Volume,Close\n2024-01-02,B,1,4,0.5,2,10,3\n")
    rows = cleanse.clean_csv_bars(readers.read_bar_csv(spark, str(tmp_path))).collect()
    assert [(r.symbol, r.close, r.volume) for r in rows] == [("A", 2.0, 10.0)]
    assert [(f.rsplit("/", 1)[-1], c) for f, c in readers.csv_rejects(spark, str(tmp_path))] == [("b.csv", "lacks or repeats Close")]


HEADER = "Date,Symbol,Open,High,Low,Close,Volume\n"
TURNED = "Volume,Symbol,Close,Low,High,Open,Date\n"


def test_every_form_of_file_is_read(spark, tmp_path):
    """Plain, gzip and bzip2, sub-folders, odd names, byte order mark, leading blank line, one order or several."""
    import bz2

    def row(symbol):
        return f"2024-01-02,{symbol},1,4,0.5,2,10\n"

    put(tmp_path, "a.csv", HEADER + row("A"))
    (tmp_path / "b.csv.gz").write_bytes(gzip.compress((HEADER + row("B")).encode()))
    put(tmp_path / "2024 [x]" / "da{y}", "c*d%20.csv", HEADER + row("C"))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "d.csv.bz2").write_bytes(bz2.compress((HEADER + row("D")).encode()))
    (tmp_path / "e.csv").write_bytes(b"\xef\xbb\xbf" + (HEADER + row("E")).encode())
    put(tmp_path, "f.csv", "\n\n" + HEADER + row("F"))
    put(tmp_path, "_hidden.csv", HEADER + row("X"))
    put(tmp_path, "blank.csv", "\n\n")
    put(tmp_path / "year=2024", "g.csv", HEADER + row("G") * 3)
    want = ["A", "B", "C", "D", "E", "F", "G", "G", "G"]
    bars = cleanse.clean_csv_bars(readers.read_bar_csv(spark, str(tmp_path)))
    assert sorted(r.symbol for r in bars.collect()) == want
    assert bars.where("open = 1 and high = 4 and low = 0.5 and close = 2 and volume = 10").count() == len(want)
    # another order, packed and in a sub-folder
    (tmp_path / "deep" / "h.csv.gz").write_bytes(gzip.compress((TURNED + "10,H,2,0.5,4,1,2024-01-02\n").encode()))
    bars = cleanse.clean_csv_bars(readers.read_bar_csv(spark, str(tmp_path)))
    assert sorted(r.symbol for r in bars.collect()) == [*want, "H"]
    assert bars.where("open = 1 and high = 4 and low = 0.5 and close = 2 and volume = 10").count() == len(want) + 1
    assert readers.csv_rejects(spark, str(tmp_path)) == []


def test_headers_of_split_files(spark, tmp_path):
    """A file of many splits has one header; no line of a later split is taken for one."""
    put(tmp_path, "a.csv", HEADER + "".join(f"2024-01-02,S{i % 7},1,4,0.5,2,{i}\n" for i in range(200000)))
    own = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1 << 18)
    try:
        bars = cleanse.clean_csv_bars(readers.read_bar_csv(spark, str(tmp_path)))
        assert bars.count() == 200000 and bars.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", own)


def test_damaged_symbol_files_are_quarantined_whole(spark, tmp_path):
    header, good = "Date,Open,High,Low,Close,Volume\n", "2024-01-02,1,4,0.5,2,10\n"
    whole = gzip.compress((header + "".join(f"2024-01-02,1,4,0.5,{i % 97},{i * 7919 % 10007}\n"
                                            for i in range(60000))).encode())
    for symbol in ("A", "B%2FC", "D E"):
        put(tmp_path / f"Symbol={symbol}", "x.csv", header + good)
    (tmp_path / "Symbol=D E" / "old").mkdir()
    (tmp_path / "Symbol=D E" / "old" / "y.csv.gz").write_bytes(gzip.compress((header + good).encode()))
    for symbol, data in (("HALF", whole[:len(whole) // 2]), ("NOGZ", b"not packed at all"),
                         ("CRC", whole[:-6] + b"\0\0\0\0\0\0")):
        (tmp_path / f"Symbol={symbol}").mkdir()
        (tmp_path / f"Symbol={symbol}" / "x.csv.gz").write_bytes(data)
    put(tmp_path / "Symbol=HALF", "z.csv", header + good)
    put(tmp_path / "Symbol=LACKS", "x.csv", "Date,Open\n2024-01-02,1\n")
    bars, rejects = readers.scan_symbol_dirs(spark, str(tmp_path))
    assert sorted(r.symbol for r in cleanse.clean_csv_bars(bars).collect()) == ["A", "B/C", "D E", "D E", "HALF"]
    assert sorted((s, f.rsplit("/", 1)[-1], why) for s, f, why in rejects) == [
        ("CRC", "x.csv.gz", "cannot be read to its end"), ("HALF", "x.csv.gz", "cannot be read to its end"),
        ("LACKS", "x.csv", "lacks or repeats High, Low, Close, Volume"),
        ("NOGZ", "x.csv.gz", "cannot be read to its end")]


def test_a_failure_that_is_no_files_fault_is_raised(spark, tmp_path, monkeypatch):
    from barlake.sources import csv_files
    put(tmp_path, "a.csv", HEADER)
    monkeypatch.setattr(csv_files, "first_lines", lambda *_: (_ for _ in ()).throw(RuntimeError("lost the cluster")))
    with pytest.raises(RuntimeError, match="lost the cluster"):
        csv_files.inspect(spark, str(tmp_path), ["Date"], skip_unreadable=True)


def test_one_file_per_symbol(spark, tmp_path):
    """However the rows are spread, a symbol's land in one file, and all are read again by few tasks."""
    from barlake.sources import csv_files
    rows = spark.range(600).selectExpr(
        "'2024-01-02' AS Date", "concat('S', id % 20) AS Symbol", "'1' AS Open", "'4' AS High", "'0.5' AS Low",
        "'2' AS Close", "cast(id AS string) AS Volume").repartition(30, "Volume")
    readers.write_symbol_files(rows, str(tmp_path / "x"))
    files = csv_files.listed(spark, str(tmp_path / "x"))
    assert len(files) == 20
    assert [line for _, line in csv_files.first_lines(spark, files)] == ["Date,Open,High,Low,Close,Volume"] * 20
    spark.sparkContext.setJobGroup("heads", "header scan")
    csv_files.first_lines(spark, files)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("heads") for s in tracker.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(s.numTasks for s in stages) < 20
    back = readers.read_symbol_dirs(spark, str(tmp_path / "x"))
    assert sorted((r.Symbol, int(r.Volume)) for r in back.collect()) == sorted((f"S{k % 20}", k) for k in range(600))


def bar_rows(spark, rows):
    """Text bar rows of (symbol, date, open)."""
    return spark.createDataFrame(rows, "Symbol string, Date string, Open string").selectExpr(
        "Date", "Symbol", "Open", "'4' AS High", "'0.5' AS Low", "'2' AS Close", "'10' AS Volume")


def files_below(folder):
    """Lines of all visible files by folder, the header first, the rest sorted."""
    found = {}
    for file in folder.rglob("[!._]*"):
        if file.is_file():
            data = gzip.decompress(file.read_bytes()) if file.suffix == ".gz" else file.read_bytes()
            assert data.endswith(b"\n")
            found.setdefault(str(file.parent.relative_to(folder)), []).append(data.split(b"\n")[:-1])
    return {k: sorted((f[0], *sorted(f[1:])) for f in v) for k, v in found.items()}


@pytest.mark.parametrize("packed", [False, True])
def test_symbol_folders_are_those_of_sparks_writer(spark, tmp_path, packed):
    odd = [f"a{chr(c)}b" for c in range(1, 128)] + [None, "", "..", " x ", "%41", "ü", "日本", "A", "B"]
    text = ["1", None, "", " 2 ", 'q"q', "a,b", "back\\slash", "#x", "ü"]
    rows = bar_rows(spark, [(s, f"2024-01-{d:02d}", text[(i + d) % len(text)]) for i, s in enumerate(odd) for d in range(1, 4)])
    (tmp_path / "ours" / "Symbol=OLD").mkdir(parents=True)
    put(tmp_path / "ours" / "Symbol=OLD", "old.csv", "gone\n")
    readers.write_symbol_files(rows, str(tmp_path / "ours"), packed=packed)
    (readers.by_symbol(rows).write.partitionBy("Symbol").option("header", True)
     .option("compression", "gzip" if packed else "none").csv(str(tmp_path / "spark")))
    assert files_below(tmp_path / "ours") == files_below(tmp_path / "spark")
    hidden = {p.name for p in (tmp_path / "ours").iterdir() if p.name[0] in "._"}
    assert hidden == {p.name for p in (tmp_path / "spark").iterdir() if p.name[0] in "._"}


def test_symbol_folders_need_no_process_per_file(spark, tmp_path, monkeypatch):
    """Neither Spark's writer nor its text reader, which pay milliseconds per file, gets many small files."""
    from pyspark.sql import DataFrameWriter

    from barlake.sources import csv_files
    rows = bar_rows(spark, [(f"S{k % 300}", "2024-01-02", str(k)) for k in range(900)])
    monkeypatch.setattr(DataFrameWriter, "csv", lambda *_, **__: pytest.fail("Spark's writer"))
    readers.write_symbol_files(rows, str(tmp_path))
    readers.write_symbol_files(rows, str(tmp_path / "more"), ["Volume", "Close", "Symbol", "Low", "High", "Open", "Date"],
                               packed=True)
    monkeypatch.setattr(csv_files, "first_lines", lambda *_: pytest.fail("Spark's text reader"))
    bars, rejects = readers.scan_symbol_dirs(spark, str(tmp_path))
    assert rejects == [] and bars.rdd.getNumPartitions() < 150
    assert sorted((r.Symbol, int(r.Open), r.High, r.Low, r.Close) for r in bars.collect()) == sorted(
        [(f"S{k % 300}", k, "4", "0.5", "2") for k in range(900)] * 2)


def test_a_write_that_fails_changes_nothing(spark, tmp_path):
    put(tmp_path / "Symbol=OLD", "old.csv", "kept\n")
    bad = bar_rows(spark, [(f"S{k}", "2024-01-02", str(k)) for k in range(50)]).selectExpr(
        "Date", "Symbol", "Open", "High", "Low", "Close", "if(Open = '7', raise_error('no'), Volume) AS Volume")
    with pytest.raises(Exception, match="no"):
        readers.write_symbol_files(bad, str(tmp_path))
    assert [str(p.relative_to(tmp_path)) for p in tmp_path.rglob("*")] == ["Symbol=OLD", "Symbol=OLD/old.csv"]


def test_damage_to_a_written_file_is_found(spark, tmp_path, monkeypatch):
    """Its checksums are kept beside a file; one that does not fit them is quarantined, or an error."""
    from barlake.sources import csv_files
    readers.write_symbol_files(bar_rows(spark, [(s, f"2024-01-{d:02d}", str(d)) for s in "ABC" for d in range(1, 29)]),
                               str(tmp_path))
    (file,) = (tmp_path / "Symbol=B").glob("*.csv")
    data = bytearray(file.read_bytes())
    assert len(data) > 512
    data[600] ^= 1
    file.write_bytes(data)
    for few, many in ((256, 1 << 14), (0, 0), (0, 1 << 14)):
        monkeypatch.setattr(csv_files, "FEW", few)
        monkeypatch.setattr(csv_files, "MANY", many)
        bars, rejects = readers.scan_symbol_dirs(spark, str(tmp_path))
        assert {r.Symbol: r["count"] for r in bars.groupBy("Symbol").count().collect()} == {"A": 28, "C": 28}
        assert [(s, why) for s, _, why in rejects] == [("B", "cannot be read to its end")]
        with pytest.raises(Exception, match="Symbol=B"):
            csv_files.rows_by_name(spark, csv_files.inspect(spark, str(tmp_path), ["Date"]), ["Date"]).collect()


def test_files_read_whole_give_the_same(spark, tmp_path, monkeypatch):
    """Many small files are read by other code than few; rows, rejects and errors are the same."""
    import bz2

    from barlake.sources import csv_files
    header, row = b"Date,Open,High,Low,Close,Volume\n", b"2024-01-02,1,4,0.5,2,10\n"
    turned = b"Volume,Note,Close,Low,Note,High,Open,Date\n10,n,2,0.5,m,4,1,2024-01-03\n10,n,2\n"
    packed = gzip.compress(header + b"".join(b"2024-01-02,1,4,0.5,%d,%d\n" % (i % 97, i * 7919 % 10007) for i in range(60000)))
    long = header + row * 100000
    data = {
        "A/a.csv": header + row * 3, "A/old/b.csv.gz": gzip.compress(header + row), "B%2FC/a.csv": turned,
        "D/two.csv.gz": gzip.compress(header + row) + gzip.compress(row), "E/turned.csv.gz": gzip.compress(turned),
        "F/mark.csv": b"\xef\xbb\xbf" + header + row, "G/blanks.csv": b"\n  \n" + header + b"\n" + row + b" \t \n\n" + row,
        "H/cr.csv": (header + row + row).replace(b"\n", b"\r"), "I/crlf.csv": (header + row + row).replace(b"\n", b"\r\n"),
        "J/quoted.csv": header + b'"2024-01-02","1,5","a""b","a\\"b", 2 ,""\n"open,1,2\n,,,,,\n2024-01-02,1\n1,2,3,4,5,6,7,8\n',
        "K/bytes.csv": header + b"\xff\xfe,\xc3\xa9,\xe6\x97,4,5,6\n", "L/no_end.csv": header + row[:-1],
        "M/header.csv": header, "N/blank.csv": b"\n\n", "N/nothing.csv": b"", "O/mark.csv": header + b"\xef\xbb\xbf" + row,
        "P/x.csv.bz2": bz2.compress(header + row), "Q/x.txt": header + row, "R/x": header + row, "S/x.CSV": header + row,
        "T/quoted_header.csv": b'"Date", Open ,High,"Low",Close,Volume\n' + row, "U/nul.csv": header + b"a\0b,1,2,3,4,5\n",
        "V/lacks.csv": b"Date,Open\n" + row, "V/twice.csv.gz": gzip.compress(b"Date," + header + row), "W/large.csv": long,
        "X/large.csv.gz": packed, "Y/half.csv.gz": packed[:len(packed) // 2], "Y/crc.csv.gz": packed[:-6] + b"\0" * 6,
        "Z/not.csv.gz": b"not packed at all", "Z/tail.csv.gz": gzip.compress(header + row) + b"tail",
        "__HIVE_DEFAULT_PARTITION__/a.csv": header + row, "a+b %20/a.csv": header + row,
    }
    for name, content in data.items():
        file = tmp_path / f"Symbol={name}"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(content)
    (tmp_path / "none.csv").write_bytes(header + row)
    assert len(long) > csv_files.SMALL_BYTES > len(packed)
    seen = {}
    for way in ("few", "local", "any store"):
        monkeypatch.setattr(csv_files, "FEW", 1 << 30 if way == "few" else 0)
        monkeypatch.setattr(csv_files, "MANY", 0 if way == "local" else 1 << 30)
        bars, rejects = readers.scan_symbol_dirs(spark, str(tmp_path))
        counts = bars.groupBy(*bars.columns).count().collect()
        seen[way] = (sorted(map(repr, counts)), [(s, f.rsplit("/", 1)[-1], why) for s, f, why in rejects])
        with pytest.raises(Exception, match="half.csv.gz|crc.csv.gz|not.csv.gz|tail.csv.gz"):
            csv_files.inspect(spark, str(tmp_path), readers.FILE_COLUMNS)
    assert seen["local"] == seen["few"] and seen["any store"] == seen["few"]
    assert sum(int(r.rsplit("count=")[1][:-1]) for r in seen["few"][0]) > 160000 and len(seen["few"][1]) == 6


@pytest.mark.parametrize("local", [True, False])
def test_small_file_gone_or_damaged_after_inspection_is_an_error(spark, tmp_path, monkeypatch, local):
    from barlake.sources import csv_files
    monkeypatch.setattr(csv_files, "FEW", 0)
    monkeypatch.setattr(csv_files, "MANY", 0 if local else 1 << 14)
    for symbol in "AB":
        (tmp_path / f"Symbol={symbol}").mkdir()
        (tmp_path / f"Symbol={symbol}" / "x.csv.gz").write_bytes(gzip.compress(
            b"Date,Open,High,Low,Close,Volume\n2024-01-02,1,4,0.5,2,10\n"))
    bars = readers.read_symbol_dirs(spark, str(tmp_path))
    assert bars.count() == 2
    whole = (tmp_path / "Symbol=A" / "x.csv.gz").read_bytes()
    (tmp_path / "Symbol=A" / "x.csv.gz").write_bytes(whole[:-9])
    with pytest.raises(Exception, match="x.csv.gz"):
        bars.collect()
    (tmp_path / "Symbol=A" / "x.csv.gz").unlink()
    with pytest.raises(Exception):
        bars.collect()


def test_many_folders_are_listed_in_rounds(spark, tmp_path, monkeypatch):
    """The tasks' listing has the files of Spark's, hidden ones left out, wherever very many folders lie."""
    from barlake.sources import csv_files
    monkeypatch.setattr(csv_files, "MANY", 3)
    for i in range(1100):
        (tmp_path / "a" / f"Symbol={i}").mkdir(parents=True)
        put(tmp_path / "a" / f"Symbol={i}", "x.csv", "Date\n" if i % 7 else "")
    for name in ("_x.csv", ".x.csv", "x._COPYING_", "_a=b.csv", "_metadata", "y z%20.csv", "ü.csv", ".hidden/x.csv",
                 "_temporary/x.csv", "_metadata.d/x.csv", "_a=1/x.csv", "b/c/x.csv.gz"):
        put((tmp_path / "a" / "Symbol=5" / name).parent, name.rsplit("/", 1)[-1], "Date\n")
    (tmp_path / "link").symlink_to(tmp_path / "a" / "Symbol=5")
    (tmp_path / "a" / "nothing").symlink_to(tmp_path / "gone")
    assert csv_files.paths_of(csv_files.many_local(spark, str(tmp_path))) == csv_files.listed(spark, str(tmp_path))
    assert csv_files.many_local(spark, str(tmp_path) + "/*") is None
    monkeypatch.setattr(csv_files, "MANY", 2000)
    assert csv_files.many_local(spark, str(tmp_path)) is None


def test_symbol_folders_on_another_store(spark, tmp_path, monkeypatch):
    """Where the store is not the local file system, Spark's writer gives the same folders."""
    from barlake.sources import folder_files
    rows = bar_rows(spark, [(s, f"2024-01-{d:02d}", str(d)) for s in ("A", "B/C", None) for d in range(1, 4)])
    for name in ("local", "other"):
        if name == "other":
            monkeypatch.setattr(folder_files, "local_path", lambda *_: None)
        readers.write_symbol_files(rows, str(tmp_path / name), packed=True)
    assert files_below(tmp_path / "local") == files_below(tmp_path / "other")
