"""A2, C1-C3, E1-E3 on hand-written lines."""

from flowengine.operators import counts
from flowengine.sinks import files
from flowengine.sources import flows as source

ROW = "2024-01-01T00:00:00,{src},10.0.0.5,5000,80,{proto},3,120,0.5,ACK,{label}"


def counted(spark, operator, *lines):
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    return {r[0]: r[1] for r in operator(frame).collect()}


def all_three(spark, line):
    return tuple(
        counted(spark, op, line)
        for op in (counts.protocol_count, counts.source_ip_count, counts.attack_distribution)
    )


def test_headers_and_blanks_are_dropped_anywhere(spark):
    for line in ("timestamp,src_ip,label", "  \ttimestamp,a,b,c,d,e,f,g,h,i,j,k", "", " \t \r", None):
        assert all_three(spark, line) == ({}, {}, {})


def test_case_and_blanks(spark):
    line = "  " + ROW.format(src="\t198.51.100.42aB ", proto=" tcp\t", label=" DDoS_Flood ") + " \r"
    assert all_three(spark, line) == ({"TCP": 1}, {"198.51.100.42aB": 1}, {"DDOS_FLOOD": 1})


def test_trailing_empty_fields_do_not_count(spark):
    line = ROW.format(src="a", proto="udp", label="")
    assert all_three(spark, line) == ({"UDP": 1}, {"a": 1}, {})


def test_arity(spark):
    assert all_three(spark, "0,1,2,3,4,5") == ({"5": 1}, {"1": 1}, {})
    assert all_three(spark, "0,1,2,3,4") == ({}, {"1": 1}, {})
    assert all_three(spark, "0") == ({}, {}, {})
    assert all_three(spark, ",,,,,,,,,,") == ({}, {}, {})


def test_inner_empty_fields_are_keys(spark):
    assert all_three(spark, "t,,d,1,2,,1,1,1,ACK,BENIGN") == ({"": 1}, {"": 1}, {"BENIGN": 1})


def test_fields_beyond_the_last_column(spark):
    line = ROW.format(src="a", proto="tcp", label="BOTNET") + ",x,y"
    assert all_three(spark, line) == ({"TCP": 1}, {"a": 1}, {"BOTNET": 1})


def test_counts_are_summed_and_written_in_key_order(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    lines = [ROW.format(src=s, proto="tcp", label="BENIGN") for s in "baab"] + ["x,c"]
    (folder / "one.csv").write_text("timestamp,src_ip\n" + "\n".join(lines[:2]))
    (folder / "two.csv").write_text("\n".join(lines[2:]) + "\ntimestamp,again\n")
    out = str(tmp_path / "counts")
    files.write_counts_tsv(counts.source_ip_count(source.read_flow_lines(spark, str(folder))), out)
    parts = sorted((tmp_path / "counts").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "a\t2\nb\t2\nc\t1\n"
