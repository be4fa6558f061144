from tallyhouse.session import settings_for


def test_partitions_follow_the_data():
    key = "spark.sql.shuffle.partitions"
    assert settings_for(0, 8)[key] == "8"
    assert settings_for(10 * 2**40, 4000)[key] == str(10 * 2**40 // 2**27)
    assert settings_for(10**17, 4000)[key] == str(10**17 // 2**27)


def test_settings_are_accepted(spark):
    session = spark.newSession()
    for name, value in settings_for(2**30, 4).items():
        session.conf.set(name, value)
    assert session.range(10).groupBy("id").count().count() == 10
