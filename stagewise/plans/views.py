"""The semantic layer: all eight views built in dependency order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stagewise.operators import clean, portfolio, process
from stagewise.session import materialize
from stagewise.sources.catalog import publish_view
from stagewise.sources.sinks import write_bucketed


def register_views(raw: dict[str, DataFrame], persist_clean: bool = False,
                   dim: str = "channel", bucket_clean: int | None = None,
                   key: str = "application_id",
                   bucket_tables: tuple[str, str] | None = None) -> dict[str, DataFrame]:
    """Publish the clean layer, the stage-SLA panel and the portfolio views.

    ``raw`` holds raw_applications, raw_stage_events, initiative_passport and
    initiative_fact.  With ``persist_clean`` the clean applications are written
    once under the shared checkpoint dir (lineage cut, survives executor loss)
    and every later view reads the written table.  With ``bucket_clean=n``
    the clean applications and clean events are saved as the tables named in
    ``bucket_tables`` (which must not exist yet), bucketed by the key into
    ``n`` buckets, so every later join between them (the panel, any ad-hoc
    query) runs without a shuffle."""
    if bucket_clean and not bucket_tables:
        raise ValueError("bucket_clean needs bucket_tables: names for the two saved tables")
    apps = clean.clean_applications(raw["raw_applications"])
    if bucket_clean:
        apps = write_bucketed(apps, bucket_tables[0], key, bucket_clean, mode="errorifexists")
    elif persist_clean:
        apps = materialize(apps, "v_applications_clean")
    views: dict[str, DataFrame] = {}
    views["v_applications_clean"] = publish_view(apps, "v_applications_clean")
    ev = clean.clean_stage_events(raw["raw_stage_events"], clean.clean_keys(raw["raw_applications"]))
    if bucket_clean:
        ev = write_bucketed(ev, bucket_tables[1], key, bucket_clean, mode="errorifexists")
        # co-located join: both sides are bucketed by the key
        ev_dim = ev.join(views["v_applications_clean"].select(key, dim), key)
    else:
        # the panel looks the channel up in the same join that keeps clean events
        ev_dim = clean.clean_stage_events(raw["raw_stage_events"], views["v_applications_clean"],
                                          attach=(dim,))
    views["v_stage_events_clean"] = publish_view(ev, "v_stage_events_clean")
    views["v_pipeline_stage_sla"] = publish_view(
        process.channel_stage_sla(ev_dim, None, dim).withColumnRenamed(dim, "channel"), "v_pipeline_stage_sla")
    plan = portfolio.initiative_plan(raw["initiative_passport"])
    views["v_initiative_plan"] = publish_view(plan, "v_initiative_plan")
    npv = portfolio.initiative_npv(plan)
    views["v_initiative_cashflow"] = publish_view(npv.drop("cum_npv_rub"), "v_initiative_cashflow")
    views["v_initiative_npv"] = publish_view(npv, "v_initiative_npv")
    views["v_portfolio_npv"] = publish_view(portfolio.portfolio_npv(npv), "v_portfolio_npv")
    views["v_initiative_fact_vs_plan"] = publish_view(
        portfolio.fact_vs_plan(raw["initiative_fact"], plan), "v_initiative_fact_vs_plan")
    return views
