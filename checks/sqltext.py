"""SQL building blocks shared by several queries."""

from __future__ import annotations

from checks.base import STATEMENTS_SQL, list_count_sql, list_first_sql

WINDOW_US = 10_800_000_000

ST = f"with st as ({STATEMENTS_SQL})"


def rolling_sql(source: str, mode: str = "all_prior", prefix: str = "platform_") -> str:
    """Frames spelled out as a self join over (id, p, us, a, kind, t) rows; t = 1 marks test rows."""
    seen = {
        "all_prior": "(r.t = 1 or b.t = 0) and (b.us < r.us or b.us = r.us and (b.t < r.t or b.t = r.t and b.id < r.id))",
        "train_only": "b.t = 0 and (b.us < r.us or b.us = r.us and r.t = 0 and b.id < r.id)",
    }[mode]
    return f"""
    (select r.id,
            case when r.t = 1 and not coalesce(bool_or(b0.has_train), false) then 0 else count(b.id) end
              as {prefix}volume_3h,
            case when r.t = 1 and not coalesce(bool_or(b0.has_train), false) or count(b.id) = 0 then 0.0
                 else round(cast(sum(b.a) as double) / count(b.id), 6) end as {prefix}auto_fraction_3h,
            case when r.t = 1 and not coalesce(bool_or(b0.has_train), false) or count(b.id) = 0 then 1
                 else count(distinct b.kind) end as {prefix}content_type_div_3h
     from {source} r
     left join (select p, bool_or(t = 0) as has_train from {source} where us is not null group by p) b0 on b0.p = r.p
     left join {source} b on b.p = r.p and b.us >= r.us - {WINDOW_US} and {seen}
     group by r.id, r.t)"""


# (id, p, us, a, kind, t) of the statements, test rows marked by row id and one platform all test.
FRAME_ROWS = f"""fr as (select row_id as id, platform_name as p, epoch_us(created_at) as us,
  case when lower(coalesce(automated_detection, '')) = 'yes' then 1 else 0 end as a,
  coalesce({list_first_sql('content_type')}, 'UNKNOWN') as kind,
  case when row_id % 5 = 0 or platform_name = 'p7' then 1 else 0 end as t from st)"""

IS_TEST = "row_id % 5 = 0 or coalesce(platform_name = 'p7', false)"

VIS = "case when decision_visibility is null then 0 else 1 end"
MON = "case when decision_monetary is null then 0 else 1 end"
PRO = "case when decision_provision is null then 0 else 1 end"
ACC = "case when decision_account is null then 0 else 1 end"
APP = "try_cast(application_date as timestamp)"
CNT = "try_cast(content_date as timestamp)"


def structured_sql() -> dict[str, str]:
    """The 24 row-wise features with missing values filled."""
    text = {
        c: f"coalesce({c}, '__MISSING__')"
        for c in (
            "source_type automated_detection automated_decision platform_name content_language account_type "
            "incompatible_content_illegal decision_ground"
        ).split()
    }
    text |= {
        "content_type_primary": f"coalesce({list_first_sql('content_type')}, '__MISSING__')",
        "territorial_scope_primary": f"coalesce({list_first_sql('territorial_scope')}, '__MISSING__')",
        "decision_visibility_primary": f"coalesce({list_first_sql('decision_visibility')}, '__MISSING__')",
    }
    number = {
        "territorial_scope_count": list_count_sql("territorial_scope"),
        "app_year": f"year({APP})",
        "app_month": f"month({APP})",
        "content_year": f"year({CNT})",
        "decision_facts_len": "length(coalesce(decision_facts, ''))",
        "content_application_lag_days": f"floor((epoch_us({APP}) - epoch_us({CNT})) / 86400000000.0)",
        "has_monetary_decision": MON,
        "has_provision_decision": PRO,
        "has_account_decision": ACC,
        "total_decision_actions": f"({VIS}) + ({MON}) + ({PRO}) + ({ACC})",
        "is_multi_action_decision": f"case when ({VIS}) + ({MON}) + ({PRO}) + ({ACC}) > 1 then 1 else 0 end",
        "content_type_count": list_count_sql("content_type"),
        "visibility_decision_count": list_count_sql("decision_visibility"),
    }
    return text | {n: f"cast(coalesce({e}, -1) as bigint)" for n, e in number.items()}


def select_list(exprs: dict[str, str]) -> str:
    return ", ".join(f"{e} as {n}" for n, e in exprs.items())
