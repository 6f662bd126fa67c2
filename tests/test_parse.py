from pyspark.sql import functions as F

from eventlab.functions import parse
from eventlab.operators.aggregates import word_counts
from eventlab.sources import readers
from helpers import ms, utc


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_event_with_and_without_fraction(spark):
    out = parse.parse_event(lines(spark, "u,PAGE_READ,2021-09-13 00:30:00.0", "v,show,2021-09-13 00:30:01"))
    assert utc(out) == [("u", "PAGE_READ", 1631493000000), ("v", "show", 1631493001000)]


def test_bad_lines_become_null_and_can_be_told_apart(spark):
    out = parse.parse_event(lines(spark, "", "u", "u,a", "u,a,yesterday", "u,a,2021-09-13 00:30:00", "u,a,2021-02-30 00:00:00"))
    assert [r.ts is not None for r in out.collect()] == [False] * 4 + [True, False]
    assert out.filter(parse.readable("user_id", "action", "ts")).count() == 1


def test_wide_event_takes_three_of_many_fields(spark):
    fields = [str(i) for i in range(23)]
    fields[5] = "2021-09-13 00:30:00"
    out = utc(parse.parse_wide_event(lines(spark, ",".join(fields), "a,b")))
    assert out == [("3", "20", 1631493000000), (None, None, None)]


def test_book_drops_the_type_and_counts(spark):
    out = parse.parse_book(lines(spark, "1,title,writer,type,girl", "2,t,w,,", "3,t"), count=True)
    assert [tuple(r) for r in out.collect()] == [
        ("1", "title", "writer", "girl", 1), ("2", "t", "w", "", 1), ("3", "t", None, None, 1)]


def test_words_keep_inner_empty_ones(spark):
    out = parse.words_of(lines(spark, "a  b ", " a", "", "   ", "a,b,,"))
    assert [r.word for r in out.collect()] == ["a", "", "b", "", "a", "", "a,b,,"]


def test_lines_of_a_text_column_and_word_count(spark):
    text = spark.createDataFrame([("to be\nor not", ), ("to be", )], "text string")
    counts = word_counts(parse.words_of(parse.lines_of(text, "text")))
    assert {r.word: r.n for r in counts.collect()} == {"to": 2, "be": 2, "or": 1, "not": 1}


def test_numbers(spark):
    out = lines(spark, "1000", "x", "").select(parse.parse_number(F.col("value")).alias("n"))
    assert [r.n for r in out.collect()] == [1000, None, None]


def test_time_text_has_a_fraction(spark):
    out = spark.sql("SELECT 'u' user_id, 'show' action, t AS ts FROM VALUES (timestamp_millis(10001)), "
                    "(timestamp_millis(10120)), (timestamp_millis(10000)) AS v(t)").select(parse.format_event().alias("x"))
    assert [r.x for r in out.collect()] == [
        "u,show,1970-01-01 00:00:10.001", "u,show,1970-01-01 00:00:10.12", "u,show,1970-01-01 00:00:10.0"]


def test_row_texts(spark):
    row = spark.sql("SELECT 'u' user_id, 3L n, timestamp_millis(0) window_start, timestamp_millis(4000) window_end")
    assert row.select(parse.format_user_count().alias("x")).first().x == "u,3,1970-01-01 00:00:00.0,1970-01-01 00:00:04.0"
    assert row.select(parse.format_tuple("user_id", "n").alias("x")).first().x == "(u,3)"


def test_kafka_records_decode(spark):
    records = spark.createDataFrame([(None, bytearray("1,ö,w,t,g".encode()), "topic", 0, 7, None, 0)],
                                    "key binary, value binary, topic string, partition int, offset bigint, "
                                    "timestamp timestamp, timestampType int")
    book = parse.parse_book(readers.decode_kafka(records)).first()
    assert (book.bid, book.title, book.gender, book.offset) == ("1", "ö", "g", 7)


def test_kafka_options():
    assert readers.kafka_options("h:1,i:1", "books", "readers") == {
        "kafka.bootstrap.servers": "h:1,i:1", "subscribe": "books", "startingOffsets": "earliest",
        "kafka.group.id": "readers"}
    assert "kafka.group.id" not in readers.kafka_options("h:1", "books")


def test_rows_and_text_files(spark, tmp_path):
    made = readers.rows(spark, [(1, "huawei", "show", None)], "seq bigint, user_id string, action string, ts timestamp")
    assert made.first().user_id == "huawei"
    (tmp_path / "a.txt").write_text("x y\n\nz\n", encoding="utf-8")
    read = readers.with_arrival(readers.text_lines(spark, str(tmp_path)))
    assert [r.value for r in read.orderBy("seq").collect()] == ["x y", "", "z"]
    assert ms(None) is None


def test_replay_ends_at_the_first_empty_line_of_each_file(spark, tmp_path):
    texts = {"a.txt": ["1", "2", "", "3", "", "4"], "b.txt": ["5", "6"], "c.txt": ["", "7"], "d.txt": [], "e.txt": [f"{i:06d}" for i in range(4000)] + [""] + ["x"] * 4000, "f.txt": ["8", " ", "9", ""]}
    for name, lines in texts.items():
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
    want = sorted(["1", "2", "5", "6", "8", " ", "9"] + texts["e.txt"][:4000])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "1000"):  # also with files cut into many splits
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            out = readers.replayed_lines(spark, str(tmp_path))
            assert out.columns == ["value"] and sorted(r.value for r in out.collect()) == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
