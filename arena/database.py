"""Query surface over the model tables: search, legality, texts, baskets and metrics as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arena.operators import baskets as k
from arena.operators import legality as lg
from arena.operators import quality as q
from arena.plans import metrics as m
from arena.sources.tables import Star


@dataclass(frozen=True)
class Database:
    """Tables with the columns of ``arena.schema``; any of them may be a view over files."""

    cards: DataFrame
    sets: DataFrame
    card_groups: DataFrame
    snapshots_table: DataFrame
    errata: DataFrame
    star: Star

    def get_card(self, card_id: str) -> DataFrame:
        return self.cards.filter(F.col("card_id") == card_id)

    def get_set(self, set_id: str) -> DataFrame:
        return self.sets.filter(F.col("set_id") == set_id)

    def list_sets(self, era: str | None = None) -> DataFrame:
        chosen = self.sets if era is None else self.sets.filter(F.col("era") == era)
        return chosen.orderBy("set_id")

    def search_cards(self, **criteria: object) -> DataFrame:
        return q.search_catalogue(self.cards, **criteria)

    def snapshots(self, format: str | None = None) -> DataFrame:
        chosen = self.snapshots_table if format is None else self.snapshots_table.filter(F.col("format") == format)
        return chosen.orderBy("format", "effective_from")

    def _groups(self) -> DataFrame:
        """Cards without a group row are a group of their own name."""
        own = self.cards.join(self.card_groups.select("card_id"), "card_id", "left_anti")
        return self.card_groups.unionByName(own.select("card_id", F.col("name_full").alias("group_key")))

    def legal_at(self, day: date, format: str) -> DataFrame:
        """Decision per active card: step, legal, banned, whitelist hits."""
        rules, overrides = lg.load_snapshot(self.snapshots_table, format, day)
        active = lg.with_names(self.cards.filter(F.col("status") == "active"), self.card_groups, rules)
        return lg.legal_decisions(active, rules, overrides)

    def effective_text(self, day: date) -> DataFrame:
        """Text in force of every card on the day."""
        rows = self.snapshots_table.select("format", "effective_from", "effective_to", F.explode("latest_text_overrides").alias("card_id", "target"))
        return lg.effective_text(self.cards.select("card_id", F.col("text_raw").alias("text")), rows, self.errata, day)

    def validate_decks(self, baskets: DataFrame, day: date, format: str) -> tuple[DataFrame, DataFrame]:
        """(violations, report) of all baskets at once: deck_id, card_id, count."""
        prism = F.contains("name_full", F.lit("◇")) | (F.col("rarity") == "PR")
        cards = self.cards.withColumn("is_prism", F.coalesce(prism, F.lit(False)))
        return k.legality_report(baskets, cards, self._groups(), self.legal_at(day, format))

    def stats_usage(self, **options: object) -> DataFrame:
        return m.ranking(m.weighted_usage(self.star, m.metric_params(**options)))

    def stats_winrate(self, layer: str = "auto", **options: object) -> DataFrame:
        return m.ranking(m.win_rate(self.star, m.metric_params(**options), layer))

    def stats_wws(self, layer: str = "auto", **options: object) -> DataFrame:
        params = m.metric_params(**options)
        return m.ranking(m.weighted_win_score(self.star, params, m.resolve_layer(self.star, params, layer)))

    def stats_card(self, group_key: str, **options: object) -> DataFrame:
        drill = m.group_drilldown(self.star, m.metric_params(**options), group_key)
        return drill.orderBy(F.col("date").desc(), "tournament_id")

    def stats_meta(self, layer: str = "a", hashes: Mapping[str, str] | None = None, **options: object) -> DataFrame:
        return m.metric_meta(self.star, m.metric_params(**options), layer=layer, hashes=dict(hashes or {}))
