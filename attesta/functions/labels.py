"""Wording chosen by the state of the data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def role_tag(office: Column, same_district: Column, basis: Column, suspended: Column) -> Column:
    """Tag of a candidate who already holds an office."""
    return (
        F.when(office.isNull(), F.lit(""))
        .when(suspended, F.lit("suspended"))
        .when(basis == "election", F.lit("elected last term"))
        .when(same_district, F.lit("incumbent"))
        .otherwise(F.concat(F.lit("incumbent "), office))
    )


def media_grain(start: Column, slots: Column, clip: Column, group_size: Column) -> Column:
    """What a media link is known to show, most specific evidence first."""
    return (
        F.when(start.isNotNull(), F.lit("own start"))
        .when(F.size(F.coalesce(slots, F.array().cast("array<long>"))) > 0, F.lit("own slots"))
        .when(clip, F.lit("clip"))
        .when(group_size > 1, F.lit("group"))
        .otherwise(F.lit("whole session"))
    )


def publication_table(office: Column, area_kind: Column) -> Column:
    """Office and kind of area → table code; null when not published."""
    return (
        F.when((office == "mayor") & (area_kind == "city"), F.lit("C1"))
        .when(office == "mayor", F.lit("C2"))
        .when((office == "councilor") & (area_kind == "city"), F.lit("T1"))
        .when(office == "councilor", F.lit("T2"))
    )


def half_links(profile_url: Column, platform_url: Column, page: Column) -> tuple[Column, Column]:
    """Each half falls back to the other's document, with a page anchor where the page is known."""
    anchor = F.when(page.isNotNull(), F.concat(F.lit("#page="), page.cast("string"))).otherwise(F.lit(""))
    return (
        F.coalesce(profile_url, F.concat(platform_url, anchor)),
        F.coalesce(platform_url, F.concat(profile_url, anchor)),
    )


def neutral_note(all_qualified: Column, any_pending: Column) -> Column:
    return (
        F.when(all_qualified, F.lit("all listed candidates are qualified"))
        .when(any_pending, F.lit("review not finished"))
        .otherwise(F.lit("some registrations were not accepted"))
    )
