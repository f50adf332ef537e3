"""playstream: episode and event-stream analytics on Spark.

    from playstream.session import build_session
    from playstream.sources import fixtures
    from playstream.plans import reports

    spark = build_session()
    games = fixtures.train_games(spark, "/data/tpch")      # or read_games(spark, path)
    reports.win_rate_by_first_card(games, n_hands=8).show()

Every function takes and returns DataFrames (chainable with ``df.transform``);
``__spark_entry__.queries()`` lists one runnable query per operator.
"""

__version__ = "0.1.0"
