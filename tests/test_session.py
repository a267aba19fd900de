from quakelake.session import pin_utc


def test_methods_too_long_for_the_jvm_are_not_generated(spark):
    session = pin_utc(spark.newSession())
    assert int(session.conf.get("spark.sql.codegen.hugeMethodLimit")) == 8_000
