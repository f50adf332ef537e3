"""Batch job: game reports and mined rules from raw game tables, as parquet.

The switch path for batch users: point it at the training and play game
tables as they are stored (columns ``Shown_cards``, ``Hand 0`` ..), and it
writes one parquet output per report (IO-01, PR-03, RP-01 .. RP-07, ML-01 ..
ML-03 from the play games, IO-02).

    python -m playstream.jobs --train T --play P --out DIR [--reports rp01,rp04]

Each output is overwritten, so a rerun refreshes it (IO-03); with
``--versions`` it is published instead (``sources.publish``), so that readers
never see it missing and a run that fails leaves the last one. Games are
numbered once, by ``--order-key`` if it is given, which the training games must
have, else as they are stored; steps and rules of the play games are derived once.
``--display-names`` writes the columns under the names that the plots read.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from .functions.episodes import normalise_games
from .operators import mining as mn
from .operators.index import with_index
from .operators.sequences import decision_steps, to_basket
from .plans import reports as rp
from .session import materialize, scratch_scope
from .sources.publish import publish
from .sources.sinks import write_result
from .sources.tables import read_games


@dataclass
class Games:
    """Numbered training games and play games, with what is derived once."""
    train: DataFrame
    play: DataFrame
    n_train: int
    n_play: int
    order_key: str | None

    @cached_property
    def steps(self) -> DataFrame:
        return materialize(decision_steps(self.play, self.n_play, self.order_key), "steps")

    @cached_property
    def rules(self):
        return mn.fit_fpgrowth(to_basket(self.steps))


K = rp.INDEX
REPORTS: dict[str, Callable[[Games], DataFrame]] = {
    "rp01_risk_by_chunk": lambda g: rp.risk_by_chunk(g.train, g.n_train, order_key=K),
    "rp02a_strategy_share_train": lambda g: rp.strategy_share(g.train, g.n_train, True, order_key=K),
    "rp02b_strategy_share_play": lambda g: rp.strategy_share(g.play, g.n_play, False, denom="total"),
    "rp02c_strategy_share_play_per500": lambda g: rp.strategy_share(g.play, g.n_play, False, denom=500),
    "rp03a_win_rate_first_card_train": lambda g: rp.win_rate_by_first_card(g.train, g.n_train, True, order_key=K),
    "rp03a_win_rate_first_card_play": lambda g: rp.win_rate_by_first_card(g.play, g.n_play, False),
    "rp03b_moves_by_shown_train": lambda g: rp.moves_by_shown(g.train, g.n_train, True, order_key=K),
    "rp03b_moves_by_shown_play": lambda g: rp.moves_by_shown(g.play, g.n_play, False),
    "rp04_win_rate_distance_train": lambda g: rp.win_rate_by_distance(g.train, g.n_train, True, order_key=K),
    "rp04_win_rate_distance_play": lambda g: rp.win_rate_by_distance(g.play, g.n_play, False),
    "rp05_hit_stats_train": lambda g: rp.hit_stats(g.train, g.n_train, True, order_key=K),
    "rp05_hit_stats_play": lambda g: rp.hit_stats(g.play, g.n_play, False),
    "rp06_risk_pivot": lambda g: rp.risk_pivot(rp.risk_by_chunk(g.train, g.n_train, order_key=K)),
    "rp07_win_matrix": lambda g: rp.win_matrix(rp.win_rate_by_distance(g.play, g.n_play, False)),
    "ml01_decision_steps": lambda g: g.steps,
    "ml02_frequent_itemsets": lambda g: mn.frequent_itemsets(g.rules),
    "ml03_association_rules": lambda g: mn.association_rules(g.rules),
}

# Column names that the plots of these reports read.
DISPLAY_NAMES = {
    "chunk_number": "Chunk Number", "risk_level": "Risk Level", "first_card": "1st Hand Card", "total_games": "TotalGames",
    "wins": "Wins", "win_rate": "Winning Rate Proportion", "proportion": "Proportion", "unique_moves": "Unique_Moves",
    "agent_hand": "Agent_hand", "distance_from_21": "Distance_from_21", "agent_first_card": "Agent_1st_Card",
    "opponent_first_card": "Opponent_1st_Card", "unique_hits": "Unique_Hits",
}


def hand_count(df: DataFrame) -> int:
    """Number of ``Hand k`` columns of a raw games table."""
    return sum(1 for c in df.columns if c.startswith("Hand "))


def run(spark: SparkSession, train_path: str, play_path: str, out_dir: str,
        names: list[str] | None = None, order_key: str | None = None,
        display_names: bool = False, versions: bool = False) -> dict[str, str]:
    raw_train, raw_play = read_games(spark, train_path), read_games(spark, play_path)
    if order_key is not None and order_key not in raw_train.columns:
        raise ValueError(f"the training games have no column {order_key}")
    n_train, n_play = hand_count(raw_train), hand_count(raw_play)
    written = {}
    with scratch_scope(spark):
        train = normalise_games(with_index(raw_train, order_key, name=rp.INDEX), n_train)
        games = Games(materialize(train, "numbered"), normalise_games(raw_play, n_play), n_train, n_play, order_key)
        for name in names or list(REPORTS):
            report = REPORTS[name](games)
            if display_names:
                report = report.withColumnsRenamed(DISPLAY_NAMES)
            path = f"{out_dir.rstrip('/')}/{name}"
            if versions:
                publish(report, path)
            else:
                write_result(report, path)
            written[name] = path
    return written


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--train", required=True)
    ap.add_argument("--play", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--reports", default="")
    ap.add_argument("--order-key")
    ap.add_argument("--display-names", action="store_true")
    ap.add_argument("--versions", action="store_true")
    args = ap.parse_args(argv)
    spark = SparkSession.builder.appName("playstream-reports").getOrCreate()
    names = [n for n in args.reports.split(",") if n] or None
    for name, path in run(spark, args.train, args.play, args.out, names, args.order_key, args.display_names, args.versions).items():
        print(name, path)


if __name__ == "__main__":
    main()
