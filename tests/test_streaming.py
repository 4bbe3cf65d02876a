import datetime as dt
import os
import tempfile

from conftest import rows
from regpanel.sources.archive import write_archives
from regpanel.sources.schemas import ELEMENTS
from regpanel.sources.xml import parse_files
from regpanel.streaming.hull import latest_intervals, stream_state_hull
from regpanel.streaming.ingest import ingest_stream

D = dt.date


def test_stream_state_hull_across_waves(spark):
    base = tempfile.mkdtemp(prefix="regpanel-stream-", dir="/tmp")
    arrivals, out, ckpt = (os.path.join(base, p) for p in ("in", "out", "ckpt"))
    schema = "tin string, state string, d date, extra string"
    waves = [
        [("t", "A", D(2020, 1, 1), "x1"), ("u", "A", D(2020, 1, 1), "y1")],
        [("t", "B", D(2020, 2, 1), "x2")],
        [("t", "A", D(2020, 3, 1), "x3")],          # A comes back: hull, not islands
    ]
    for w in waves:
        df = spark.createDataFrame(w, schema)
        df.write.mode("append").parquet(arrivals)
        stream_state_hull(spark, arrivals, df.schema, ["tin", "state"], "d", out,
                          carry=["extra"], checkpoint_location=ckpt).awaitTermination()
    got = rows(latest_intervals(spark, out, ["tin", "state"]), "tin", "state", "extra", "start_date", "end_date")
    assert got == [("t", "A", "x1", D(2020, 1, 1), D(2020, 3, 1)),
                   ("t", "B", "x2", D(2020, 2, 1), D(2020, 2, 1)),
                   ("u", "A", "y1", D(2020, 1, 1), D(2020, 1, 1))]


def test_ingest_stream_reads_each_archive_once(spark):
    base = tempfile.mkdtemp(prefix="regpanel-ingest-", dir="/tmp")
    arch, out, ckpt = (os.path.join(base, p) for p in ("zips", "out", "ckpt"))
    doc = ('<Документ ДатаСост="31.12.2020" ДатаДок="01.02.2021"><СведНП ИННЮЛ="{t}"/>'
           '<СведССЧР КолРаб="5"/></Документ>')

    def parse(members):
        docs, _ = parse_files(members, ELEMENTS["empl"], keep=("member",))
        return docs

    for i in range(2):
        files = spark.createDataFrame(
            [(f"w{i}-{j}.xml", f"<Файл>{doc.format(t=f'{i}{j}')}</Файл>") for j in range(3)],
            "member string, xml string")
        write_archives(files, arch, 1, prefix=f"wave{i}").collect()
        ingest_stream(spark, arch, out, parse, checkpoint_location=ckpt).awaitTermination()
    got = sorted(r["org_tin"] for r in spark.read.parquet(out).collect())
    assert got == ["00", "01", "02", "10", "11", "12"]
