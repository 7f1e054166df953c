"""Schemas of the model tables, for readers and for users who bring their own data."""

from __future__ import annotations

TOURNAMENTS = """tournament_id string, source string, series_id string, name string, tier string, tier_coef double, division string,
date date, location string, participant_count int, topcut_slots int, format string, env string, is_qual boolean, is_team boolean"""

DECKS = "deck_id string, archetype_id string, archetype_name string, mapping_status string, mapped_ratio double, source string"

APPEARANCES = """deck_id string, tournament_id string, rank int, points double, player_ref string,
record_wins int, record_losses int, record_ties int, source string"""

DECK_CARDS = "deck_id string, card_id string, raw_name string, count long, stat_scope string"

PAIRINGS = "tournament_id string, phase int, round int, table_no int, player1 string, player2 string, winner string"

CARDS = """card_id string, set_id string, number string, number_display string, name_full string, species string, owner string,
card_type string, trainer_subtype string, mark string, rarity string, stage string, hp int, types array<string>,
evolves_from_text string, rule_box_type string, has_rule_box boolean, is_tera boolean, prize_cards int, deck_limit int,
is_ace_spec boolean, is_basic_energy boolean, provides array<string>, text_raw string, name_en string, name_ja string,
release_date date, status string"""

SETS = "set_id string, name_zh string, era string, release_date date, regulation_mark string, expected_count int"

CARD_GROUPS = "card_id string, group_key string"

SNAPSHOTS = """snapshot_id string, format string, effective_from date, effective_to date, allowed_marks array<string>,
allowed_energies array<string>, whitelist array<struct<name_full: string, note: string>>,
banned array<struct<name: string, ability_or_attack: string, note: string>>,
mark_overrides array<struct<card_id: string, mark: string, note: string>>, latest_text_overrides map<string, string>"""

ERRATA = "errata_id string, card_id string, effective_from date, corrected_text string"

MISSES = """deck_id string, raw_name string, raw_set string, raw_number string, resolved_name string, miss_kind string,
resolved_card_id string, first_seen_at date, resolved_at date"""
