"""SQL for the derived source tables, shared by the equivalents.

``with_tables("a", "b")`` gives a WITH clause holding the named relations and
those they need, in order.
"""

from __future__ import annotations

import re

SALT = "tests-salt"
AS_OF = "2025-01-01"

_AVG = "round({total}::double / nullif({count}, 0) * {scale}) / {scale}"

RELATIONS = {
    "billing_source": """
        select cast(o_orderkey as varchar) as id,
               case when o_orderpriority = '5-LOW' and o_orderstatus = 'O' then null
                    else 'C' || o_custkey end as contato_id,
               cast(case when o_orderpriority = '1-URGENT' and o_orderstatus = 'P' then 0
                    else o_totalprice end as decimal(13,4)) as valor,
               'BRL' as valor_currency,
               cast(o_orderdate as date) as data_recebimento,
               case o_orderstatus when 'F' then 'PAGO' when 'O' then 'Pendente' else 'Cancelado' end as status,
               o_orderdate as created_at, o_orderdate as modified_at,
               case when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'P' then 1 else 0 end as deleted
        from orders""",
    "visits": """
        select o_custkey,
               cast(sum(case when o_orderstatus = 'F' then 1 else 0 end) as integer) as c_qtd_consultas,
               cast(max(case when o_orderstatus = 'F' then o_orderdate end) as date) as c_ultima_visita,
               min(o_orderdate) as created_at, max(o_orderdate) as modified_at
        from orders group by o_custkey""",
    "contact_source": """
        select 'C' || c_custkey as id,
               case when c_mktsegment = 'BUILDING' then '  Finalizado '
                    when c_mktsegment = 'MACHINERY' then 'Novo Lead'
                    when c_acctbal >= -900 then c_mktsegment end as c_status_atendimento,
               cast(c_acctbal as decimal(13,4)) as c_lifetime_value, 'brl' as c_lifetime_value_currency,
               cast(c_nationkey * 400 as decimal(13,4)) as c_potencial_venda, 'brl' as c_potencial_venda_currency,
               c_qtd_consultas, c_ultima_visita, d.text as c_aisummary, created_at, modified_at,
               c_name as first_name,
               case when c_mktsegment in ('BUILDING', 'MACHINERY') then '+55819' else '+55 81 9' end
                   || lpad(cast(c_custkey as varchar), 8, '0') as phone_number,
               case when c_acctbal < -950 then 1 else 0 end as deleted
        from customer left join visits on c_custkey = o_custkey left join documents d on d.doc_id = c_custkey
        union all
        select 'S' || s_suppkey, 'Finalizado', cast(s_acctbal as decimal(13,4)), 'brl',
               cast(s_nationkey * 400 as decimal(13,4)), 'brl', null, null, '   ', null, null,
               s_name, '5511' || lpad(cast(s_suppkey as varchar), 8, '3'), 0
        from supplier""",
    "billing": "select * from billing_source where deleted = 0",
    "contacts": "select * from contact_source where deleted = 0",
    "stg_recebimentos": f"""
        select sha256(contato_id || '{SALT}') as contato_hash, cast(valor as decimal(10,2)) as valor,
               lower(valor_currency) as moeda, data_recebimento, lower(status) as status,
               cast(created_at as date) as created_at, cast(modified_at as date) as modified_at
        from billing where valor > 0 and contato_id is not null""",
    "stg_contacts": f"""
        select sha256(id || '{SALT}') as contato_hash, lower(trim(c_status_atendimento)) as status_atendimento,
               cast(c_lifetime_value as decimal(13,2)) as lifetime_value,
               upper(c_lifetime_value_currency) as lifetime_value_moeda,
               cast(c_potencial_venda as decimal(13,2)) as potencial_venda,
               upper(c_potencial_venda_currency) as potencial_venda_moeda,
               cast(c_qtd_consultas as integer) as qtd_consultas, c_ultima_visita as ultima_visita,
               c_aisummary as ai_summary,
               cast(created_at as date) as created_at, cast(modified_at as date) as modified_at
        from contacts where id is not null""",
    "stg_ai_summaries": """
        select contato_hash, ai_summary,
               case when length(ai_summary) < 50 then 'too_short' else 'ok' end as summary_quality,
               length(ai_summary) as summary_length, created_at, modified_at
        from stg_contacts where ai_summary is not null and length(trim(ai_summary)) > 0""",
    "fct_ltv": f"""
        select contato_hash, sum(valor) as ltv_acumulado,
               {_AVG.format(total='sum(valor)', count='count(*)', scale=100)} as ticket_medio,
               max(valor) as maior_pagamento, count(*) as frequencia_visitas,
               min(data_recebimento) as primeira_visita, max(data_recebimento) as ultima_visita,
               date '{AS_OF}' - max(data_recebimento) as dias_desde_ultima_visita
        from stg_recebimentos group by contato_hash""",
    "billing_agg": """
        select contato_hash, sum(valor) as total_pago, count(*) as total_pagamentos,
               min(data_recebimento) as primeiro_pagamento, max(data_recebimento) as ultimo_pagamento
        from stg_recebimentos group by contato_hash""",
    "fct_pipeline": f"""
        select c.contato_hash, status_atendimento, lifetime_value, lifetime_value_moeda, potencial_venda,
               potencial_venda_moeda, coalesce(total_pago, 0) as total_pago_recebimentos,
               coalesce(total_pagamentos, 0) as total_pagamentos, qtd_consultas, ultima_visita,
               primeiro_pagamento, ultimo_pagamento,
               date '{AS_OF}' - ultima_visita as dias_desde_ultima_visita,
               case when status_atendimento = 'finalizado' and coalesce(total_pago, 0) = 0 then 'churned'
                    when potencial_venda > lifetime_value then 'upsell_opportunity'
                    when qtd_consultas >= 3 then 'loyal' else 'active' end as pipeline_segment,
               created_at, modified_at
        from stg_contacts c left join billing_agg b on c.contato_hash = b.contato_hash""",
    "fct_ai_performance": f"""
        select summary_quality, count(*) as total_contacts,
               {_AVG.format(total='sum(summary_length)', count='count(summary_length)', scale=1)} as avg_summary_length,
               sum(lifetime_value) as total_ltv,
               {_AVG.format(total='sum(lifetime_value)', count='count(lifetime_value)', scale=100)} as avg_ltv,
               sum(potencial_venda) as total_potencial,
               {_AVG.format(total='sum(potencial_venda)', count='count(potencial_venda)', scale=100)} as avg_potencial,
               {_AVG.format(total='sum(qtd_consultas)', count='count(qtd_consultas)', scale=10)} as avg_consultas,
               round(count(*) * 100.0::double / nullif((select count(*) from stg_contacts), 0) * 100) / 100 as coverage_pct
        from stg_ai_summaries s join stg_contacts c using (contato_hash)
        group by summary_quality""",
    "messages": """
        select event_id, user_id, ts, event_type || ' ' || props as text,
               case when user_id < 40 then '+55 81 9' else '81 9' end
                   || lpad(cast(user_id * 17 as varchar), 8, '0') as phone
        from events""",
    "phones": "select distinct trim(replace(replace(phone, '+', ''), ' ', '')) as clean from messages",
    "summary_json": """
        select event_id, user_id, ts,
               case when user_id < 40 then '+55 81 9' else '81 9' end
                   || lpad(cast(user_id * 17 as varchar), 8, '0') as phone,
               '{' || case when event_type = 'signup' then '"cliente": "Ana Maria U' || user_id || '", '
                           when event_type = 'purchase' then '"cliente": "Bruno", '
                           when event_type = 'error' and value > 400 then '"cliente": null, ' else '' end
               || '"intencao": "' || case when event_type = 'click' then 'Inquiry'
                           when event_type = 'purchase' then 'Scheduling' when event_type = 'error' then 'Complaint'
                           when value > 450 then 'Sale' else 'Other' end
               || '", "potencial": ' || case when value < 1 then '-' || cast(value as decimal(9,2))
                           when value > 480 then '"high"' else cast(cast(value as decimal(9,2)) as varchar) end
               || ', "qtd_consultas": ' || regexp_extract(props, '([0-9]+)', 1)
               || case when cast(regexp_extract(props, '([0-9]+)', 1) as integer) > 80
                       then ', "fobias_alergias": "needle_phobia"' else '' end
               || case when event_type = 'view'
                       then ', "obs": "CPF 123.456.789-00 CNPJ 12.345.678/0001-90"' else '' end
               || ', "canal": "chat"}' as summary_json
        from events""",
    "parsed": """
        select event_id, phone, ts,
               case when json_type(j, '$.cliente') is null then 'Not identified' else j->>'$.cliente' end as cliente,
               case when json_type(j, '$.intencao') is null then 'Other' else j->>'$.intencao' end as intencao,
               case when json_type(j, '$.solicitacao') is null then 'Not identified' else j->>'$.solicitacao' end as solicitacao,
               case when json_type(j, '$.obs') is null then 'No additional notes' else j->>'$.obs' end as obs,
               case when json_type(j, '$.fobias_alergias') is null then 'None reported'
                    else j->>'$.fobias_alergias' end as fobias_alergias,
               case when json_type(j, '$.historico') is null then 'No history available'
                    else j->>'$.historico' end as historico,
               case when json_type(j, '$.ltv_pago') is null then 0.0::double
                    else try_cast(j->>'$.ltv_pago' as double) end as ltv_pago,
               case when json_type(j, '$.potencial') is null then 0.0::double
                    else try_cast(j->>'$.potencial' as double) end as potencial,
               case when json_type(j, '$.qtd_consultas') is null then 0
                    else try_cast(j->>'$.qtd_consultas' as integer) end as qtd_consultas,
               json_type(j, '$.cliente') = 'NULL' as null_cliente
        from (select event_id, phone, ts, summary_json::json as j from summary_json)""",
    "checked": """
        select *, concat_ws(',',
               case when null_cliente then 'cliente' end,
               case when intencao is null or intencao not in ('Inquiry', 'Scheduling', 'Complaint', 'Other')
                    then 'intencao' end,
               case when potencial is null or potencial < 0 then 'potencial' end,
               case when qtd_consultas is null or qtd_consultas < 0 then 'qtd_consultas' end) as violations
        from parsed""",
    "valid_summaries": """
        select *, replace(replace(obs, '123.456.789-00', '***.***.***-**'),
                          '12.345.678/0001-90', '**.***.***/****-**') as masked_obs,
               trim(replace(replace(phone, '+', ''), ' ', '')) as clean
        from checked where violations = ''""",
    "crm_notes": """
        select event_id, '**AI Clinical Summary:**' || chr(10) || cliente || '. ' || fobias_alergias || '. ' || historico
               || chr(10) || chr(10) || '**Technical Note:**' || chr(10) || '- Client: ' || cliente || chr(10)
               || '- Intent: ' || intencao || chr(10) || '- Request: ' || solicitacao || chr(10)
               || '- Notes: ' || masked_obs || chr(10)
               || '- Estimated potential: R$ ' || printf('%.2f', potencial) || chr(10)
               || '- Visit count: ' || qtd_consultas as note
        from valid_summaries""",
    "contact_matches": """
        select p.clean, coalesce(
                   (select min(c.id) from contacts c
                    where replace(replace(c.phone_number, '+', ''), ' ', '') = p.clean),
                   (select min(c.id) from contacts c
                    where contains(replace(replace(c.phone_number, '+', ''), ' ', ''), p.clean))) as contact_id
        from phones p""",
    "services_source": """
        select p_partkey as item_id, p_name || ' ' || p_type as service_name, p_type as category,
               cast(p_retailprice as decimal(10,2)) as price from part""",
    "interactions_source": """
        select cast(event_id as varchar) as interaction, 'C' || user_id as contato_id,
               cast(regexp_extract(props, '([0-9]+)', 1) as bigint) as item_id,
               case when event_type <> 'view' then cast(value as decimal(12,2)) * 2 end as potential,
               case event_type when 'click' then 'Inquiry' when 'purchase' then 'Scheduling'
                    when 'error' then 'Complaint' else 'Other' end as ai_intent,
               case when value > 150 then 'needle_phobia' else 'none' end as fear,
               case when event_type = 'purchase' then cast(value as decimal(12,2)) end as paid,
               ts as created_at
        from events""",
    "dim_patients": f"""
        select sha256(contato_id || '{SALT}') as patient_key,
               max((created_at, interaction, ai_intent))[3] as intent_segment,
               max((created_at, interaction, fear))[3] as fear_segment,
               cast(min(created_at) as date) as first_contact, cast(max(created_at) as date) as last_contact,
               count(paid) as total_visits
        from interactions_source group by contato_id""",
    "dim_services": """
        select row_number() over (order by md5(service_name)) as service_key, service_name, min(category) as category,
               round(sum(price)::double / count(price) * 100) / 100 as avg_price_brl
        from services_source group by service_name""",
    "dim_date": """
        select cast(day as date) as date_key, year(day) as year, month(day) as month, quarter(day) as quarter,
               isodow(day) as day_of_week, isodow(day) >= 6 as is_weekend
        from (select unnest(generate_series(date_trunc('day', min(created_at)), max(created_at), interval 1 day)) as day
              from interactions_source)""",
    "fact_interactions": f"""
        select left(m, 8) || '-' || m[9:12] || '-' || m[13:16] || '-' || m[17:20] || '-' || m[21:32] as interaction_id,
               patient_key, service_key, cast(created_at as date) as date_key,
               coalesce(potential, 0) as estimated_potential, ai_intent,
               case when paid is null then 0 else 1 end as visit_count, coalesce(paid, 0) as valor_pago,
               coalesce(total_pago, 0) as ltv_acumulado, created_at
        from (select *, md5(interaction) as m, sha256(contato_id || '{SALT}') as patient_key from interactions_source) i
        left join services_source using (item_id) left join dim_services using (service_name)
        left join billing_agg on patient_key = contato_hash""",
}

_WORD = re.compile(r"[a-z_]+")


def _closure(names: tuple[str, ...], relations: dict[str, str]) -> list[str]:
    """The relations needed, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for used in _WORD.findall(relations[name]):
            if used in relations and used != name:
                visit(used)
        ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_tables(*names: str, replaced: dict[str, str] | None = None) -> str:
    """A WITH clause; CTE names that equal column aliases cost nothing. ``replaced`` gives some relations anew."""
    relations = RELATIONS | (replaced or {})
    parts = [f"{name} as ({relations[name].strip()})" for name in _closure(names, relations)]
    return "with " + ",\n".join(parts) + "\n"
