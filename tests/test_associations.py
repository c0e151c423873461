"""Association arrays cut out of the text are those that the JSON parser gives."""

from pyspark.sql import functions as F

from ledgerloom.functions.nested import ASSOCIATIONS, associations


def test_associations_read_as_the_parser_reads_them(spark):
    texts = [None, "", "[]", " [] ", "junk", "null", "[null]", "{}", '[{"id":"1","type":"x"}]', '[{"id":"1","type":"x"}]\n', '[{"id":"1","type":"x"}]]',
             '[{"id":"1","type":"x"},{"id":"2","type":"x"}]', '[{"id":"","type":""}]', '[{"id":"a\\n","type":"x"}]', '[{"type":"x","id":"1"}]', '[{"id":"1"}]',
             '[{"id":1,"type":"x"}]', '[{"id":"1","type":null}]', '[{"id":"1" ,"type":"x"}]', '{"id":"1","type":"x"}']
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", associations(F.col("t")).alias("got"), F.from_json("t", ASSOCIATIONS).alias("want"))
    assert [r.t for r in rows.collect() if r.got != r.want] == []
