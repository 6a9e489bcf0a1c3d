"""DuckDB SQL of the registered queries: shared views as common table expressions, and one statement each."""

from __future__ import annotations

NOW_S = 1706572800
# Later ones use earlier ones.
VIEWS = {
    "ev": "select event_id, epoch_us(ts) // 1000000 as ts_s, cast(user_id as varchar) as uid, user_id, event_type, value, epoch_us(ts) // 300000000 - 5680224 + 1 as ledger_seq, (epoch_us(ts) // 300000000 + 1) * 300 as closed_s, cast(json_extract_string(props, '$.k') as bigint) as k from events",
    "raw": "select ledger_seq, closed_s, md5(concat(ledger_seq, ':', user_id)) as tx_hash, dense_rank() over (partition by ledger_seq order by user_id) as tx_index, row_number() over (partition by ledger_seq, user_id order by event_id) - 1 as event_index, uid as emitter, case when event_type = 'purchase' then 'transfer' else event_type end as symbol, case when event_type = 'purchase' and value >= 5 then cast(k as varchar) end as recipient, to_base64(encode(cast(event_id as varchar))) as raw_xdr from ev",
    "disc": "select uid as contract_id, min(ledger_seq) as ledger_seq, min(event_id) as log_seq from (select *, row_number() over (partition by uid order by ledger_seq, event_id) as r from ev where event_type = 'signup' and k % 4 = 0) where r = 1 group by uid",
    "log": "select contract_id, 'discover' as op, ledger_seq as effective, 1 as late, log_seq from disc union all select uid, case when k < 2 then 'remove' else 'track' end, ledger_seq + 1, 0, event_id from ev where event_type = 'error' and k <= 2",
    "fold": "select *, case when x = 'track' then 'tracked' when x is not null then 'tombstoned' when m then 'tracked' else 'untracked' end as status from (select *, last_value(case when op <> 'discover' then op end ignore nulls) over w as x, bool_or(op = 'discover') over w as m from log window w as (partition by contract_id order by effective, late, log_seq rows between unbounded preceding and current row))",
    "wnow": "select contract_id, status from (select *, row_number() over (partition by contract_id order by effective desc, late desc, log_seq desc) as r from fold) where r = 1",
    "turns": "select *, lag(status = 'tracked') over (partition by contract_id order by effective) as was from (select *, row_number() over (partition by contract_id, effective order by late desc, log_seq desc) as r from fold) where r = 1",
    "iv": "select contract_id, effective as from_ledger, to_ledger from (select *, lead(effective) over (partition by contract_id order by effective) as to_ledger from turns where was is null or was <> (status = 'tracked')) where status = 'tracked'",
    "facts": "select case when e.contract_id is not null then 'event' else 'deposit' end as type, coalesce(e.contract_id, t.contract_id) as contract_id, case when e.contract_id is not null then symbol else 'token_transfer' end as event_kind, raw.ledger_seq, closed_s as closed_at, tx_hash, tx_index, event_index, raw_xdr from raw left join iv e on emitter = e.contract_id and ledger_seq >= e.from_ledger and (e.to_ledger is null or ledger_seq < e.to_ledger) left join iv t on recipient = t.contract_id and ledger_seq >= t.from_ledger and (t.to_ledger is null or ledger_seq < t.to_ledger) where e.contract_id is not null or t.contract_id is not null",
    "led": "select ledger_seq, closed_s, md5(cast(ledger_seq as varchar)) as ledger_hash, case when ledger_seq % 97 = 0 then md5('fork') else md5(cast(lag(ledger_seq) over (order by ledger_seq) as varchar)) end as prev_hash, closed_s + (ledger_seq // 50) % 40 * 60 as processed_s from (select distinct ledger_seq, closed_s from ev)",
    "entries": "select uid as contract_id, event_id as pos, event_type = 'click' as is_data, case when event_type = 'click' then 'vec/persistent' else 'instance/persistent' end as key_kind, ledger_seq as last_modified_ledger, to_base64(encode(cast(event_id as varchar))) as raw_xdr from (select *, row_number() over (partition by uid, event_type order by event_id desc) as r from ev where event_type in ('view', 'click') and user_id % 17 <> 0) where r = 1",
    "picked": "select * exclude (r) from (select *, row_number() over (partition by contract_id order by is_data desc, case when is_data then pos else -pos end) as r from entries) where r = 1",
    "tracked": "select contract_id from wnow where status = 'tracked'",
    "changes": "select contract_id, 'updated' as state_change_type, raw_xdr, last_modified_ledger from picked semi join tracked using (contract_id)",
    "all_states": "select * from changes union all select contract_id, 'removed', '', 0 from tracked anti join changes using (contract_id)",
    "states": "select contract_id, state_change_type, case when last_modified_ledger = 0 then 8640 else last_modified_ledger end as ledger_seq, raw_xdr, last_modified_ledger from all_states",
    "gaps": "select ledger_seq + 1 as from_ledger, after - 1 as to_ledger from (select ledger_seq, lead(ledger_seq) over (order by ledger_seq) as after from led) where after > ledger_seq + 1",
    "guard": "select batch_id, count(*) as requested, cast(sum(case when missing then 1 else 0 end) as bigint) as missing from (select user_id % 7 as batch_id, user_id % 7 < 3 or p.contract_id is null as missing from (select distinct uid, user_id from ev) left join picked p on uid = p.contract_id) group by batch_id",
    "suppressed": "select coalesce(cast(sum(missing) filter (requested >= 10 and 2 * missing > requested) as bigint), 0) as suppressed from guard",
    "keys": "select concat(tx_hash, ':', event_index) as message_id, concat('stellar.testnet.escrow.', type, '.', event_kind) as topic_key, * from facts",
    "errs": "select event_id as cmd_seq, case when k < 20 then 'track_escrow' when k < 40 then 'reseed' when k < 60 then 'pause' when k < 80 then 'resume' else 'dance' end as command, case when k % 2 = 0 then uid else '' end as contract_id, k % 3 = 0 as has_ids, (k - 45) * 300 as ttl from ev where event_type = 'error'",
    "pauses": "select cmd_seq, from_s, least(from_s + ttl, after) as to_s from (select *, lead(from_s) over (order by from_s, cmd_seq) as after from (select event_id as cmd_seq, k, ts_s as from_s, least(case when coalesce(trunc(value), 0) <= 0 then 600 else cast(trunc(value) as bigint) end, 3600) as ttl from ev where event_type = 'error' and k in (3, 4))) where k = 3",
    "stat": f"select (select coalesce(bool_or(from_s <= {NOW_S} and to_s > {NOW_S}), false) from pauses) as paused, l.*, {NOW_S} - closed_s as age, {NOW_S} - p as silent, (select count(*) from tracked) as tracked, (select count(*) from facts) as events, (select count(*) from states) as n_states, (select count(*) from gaps) as n_gaps, (select suppressed from suppressed) as suppressed from (select max(ledger_seq) as current_ledger, arg_max(closed_s, ledger_seq) as closed_s, max(processed_s) as p from led) l",
    "tip": "select ledger_seq, processed_s - closed_s <= 1200 as at_tip from led",
}

STATE_ID = "concat(contract_id, ':', ledger_seq)"
GAP_ID = "concat('gap:testnet:', from_ledger, ':', to_ledger)"
WIRE = f"""concat('{{"schema_version":"1.1","type":"', type, '","network":"testnet","contract_id":"', contract_id, '","ledger_seq":', ledger_seq, ',"ledger_closed_at":"', strftime(make_timestamp(closed_at * 1000000), '%Y-%m-%dT%H:%M:%SZ'), '","tx_hash":"', tx_hash, '","tx_index":', tx_index, ',"event_kind":"', event_kind, case when event_index = 0 then '"' else concat('","event_index":', event_index) end, ',"raw_xdr":"', raw_xdr, '","message_id":"', message_id, '","published_at":"2024-01-30T00:00:00Z"}}')"""
GAUGES = {"current_ledger": "current_ledger", "ledger_age_seconds": "age", "seconds_since_last_ledger": "silent", "known_escrows": "tracked", "gaps_recorded": "n_gaps", "ready": "case when silent > 60 then 0 else 1 end", "paused": "case when paused then 1 else 0 end", "uptime_seconds": "3600"}
COUNTERS = {"events_published_total": "events", "state_changes_published_total": "n_states", "suppressed_removals_total": "suppressed"}

SOURCE_WINDOWS = "w as (select 0 as priority, min(ledger_seq) as oldest, max(ledger_seq) as latest from led where ledger_seq >= 4000 union all select 1, min(ledger_seq), max(ledger_seq) from led where ledger_seq % 2 = 0)"

STATEMENTS = {
    "scan_range": "select ledger_seq, ledger_hash from led where ledger_seq between 1000 and 2000",
    "resolve_start": "select cursor, start, coalesce(cursor + 1, nullif(start, 0), (select max(ledger_seq) from led)) as resolved from (select case when ledger_seq % 3 = 0 then ledger_seq end as cursor, case when ledger_seq % 2 = 0 then ledger_seq else 0 end as start from led)",
    "clamp_start": "select start, oldest, latest, outcome, case when outcome = 'clamped' then oldest when outcome = 'ok' then start end as resolved, case when outcome = 'clamped' then start end as gap_from, case when outcome = 'clamped' then oldest - 1 end as gap_to, case when outcome = 'clamped' then 'rpc_retention' end as reason from (select *, case when oldest > latest then 'inverted' when start > latest + 60 then 'beyond_tip' when start < oldest then 'clamped' else 'ok' end as outcome from (select ledger_seq as start, cast(case when ledger_seq % 11 = 0 then 9000 else 2000 end as bigint) as oldest, cast(7000 as bigint) as latest from led))",
    "require_full_range": "select ledger_seq from led where ledger_seq between 100 and 8000 and (select min(ledger_seq) <= 100 and max(ledger_seq) >= 8000 from led)",
    "coalesce_sources": "select ledger_seq, cast(case when ledger_seq >= 4000 then 0 else 1 end as bigint) as priority, ledger_hash from led where ledger_seq >= 4000 or ledger_seq % 2 = 0",
    "source_cover": f"with {SOURCE_WINDOWS}, e as (select oldest as edge from w union select latest + 1 from w), p as (select edge as a, lead(edge) over (order by edge) - 1 as b from e), s as (select a, b, min(priority) as priority from p join w on oldest <= a and latest >= b group by a, b), m as (select *, case when lag(priority) over (order by a) = priority and lag(b) over (order by a) + 1 = a then 0 else 1 end as begins from s), n as (select *, sum(begins) over (order by a) as run from m) select min(a) as from_ledger, max(b) as to_ledger, cast(min(priority) as bigint) as priority from n group by run",
    "covered_ledgers": f"with {SOURCE_WINDOWS} select ledger_seq, cast(priority as bigint) as priority, ledger_hash from (select ledger_seq, ledger_hash, min(priority) as priority from led join w on ledger_seq between oldest and latest group by ledger_seq, ledger_hash) where ledger_seq between 2000 and 8000 and (priority = 0 or ledger_seq % 2 = 0)",
    "read_seed_list": "select uid as contract_id from ev where k >= 40",
    "load_state": "select uid as contract_id, case when bool_or(k < 3) then 'tombstoned' else 'tracked' end as status from ev group by uid",
    "replay_watchlist": "select contract_id, status from (select *, row_number() over (partition by contract_id order by effective desc, late desc, log_seq desc) as r from fold where effective <= 4000) where r = 1",
    "entry_lookup": "select u.uid as contract_id, pos, key_kind, last_modified_ledger from (select distinct uid from ev) u left join entries e on u.uid = e.contract_id",
    "sink_topic": f"select topic_key, message_id, {WIRE} as value from keys",
    "split_valid": "select case when event_index = 0 and ledger_seq % 5 = 0 then concat(tx_hash, ':', event_index) else message_id end as message_id, case when event_index = 0 and ledger_seq % 5 = 0 then 'missing tx_hash' else '' end as reason from keys",
    "route": "select message_id, unnest(list_filter(['all', case when type = 'event' then 'history' end, case when type = 'deposit' then 'deposits' end, case when type = 'event' and event_kind = 'view' then 'one' end], lambda x: x is not null)) as queue from keys",
    "unroutable": "select message_id, topic_key from keys where not (type = 'event' and event_kind = 'view')",
    "instance_filter": "select uid as contract_id, ledger_seq, event_id as log_seq from ev where event_type = 'signup' and event_id % 3 <> 0 and event_id % 5 <> 0",
    "first_topic_symbol": "select raw_xdr, symbol from raw",
    "transfer_shape": "select raw_xdr, recipient from raw where recipient is not null",
    "event_envelope": f"select '1.1' as schema_version, type, 'testnet' as network, contract_id, ledger_seq, closed_at as ledger_closed_at, tx_hash, tx_index, event_kind, event_index, raw_xdr, message_id, cast({NOW_S} as bigint) as published_at from keys",
    "state_envelope": f"select 'state' as type, contract_id, ledger_seq, state_change_type, raw_xdr, {STATE_ID} as message_id, cast({NOW_S} as bigint) as published_at from states",
    "gap_envelope": f"select 'control' as type, to_ledger + 1 as ledger_seq, '' as raw_xdr, {GAP_ID} as message_id, 'gap' as control_kind, from_ledger as gap_from_ledger, to_ledger as gap_to_ledger, 'rpc_retention' as gap_reason, cast({NOW_S} as bigint) as gap_detected_at from gaps",
    "routing_key": f"select message_id, topic_key from keys union all select {STATE_ID}, concat('stellar.testnet.escrow.state.', state_change_type) from states union all select {GAP_ID}, 'stellar.testnet.escrow.control.gap' from gaps",
    "wire_json": f"select message_id, {WIRE} as value from keys",
    "validate_envelope": "select message_id, case when n % 11 = 0 then 'unknown type' when n % 5 = 0 then 'missing raw_xdr' when n % 7 = 0 then 'missing event_kind' end as reason from (select *, tx_index + ledger_seq as n from keys)",
    "filter_unchanged": "select contract_id, state_change_type, last_modified_ledger from states where state_change_type = 'removed' or last_modified_ledger >= 6000",
    "validate_command": "select cmd_seq, command, case when command = 'track_escrow' and contract_id = '' then 'no contract_id' when command = 'reseed' and not has_ids then 'no contract_ids' when command = 'pause' and ttl < 0 then 'ttl below zero' when command = 'pause' and ttl > 3600 then 'ttl over an hour' when command = 'dance' then 'unknown command' end as reject_reason from errs",
    "pause_ttl": "select cmd_seq, least(case when ttl <= 0 then 600 else ttl end, 3600) as ttl from errs",
    "classify_fetch_errors": "select event_id, case when k < 30 then 'beyond_tip' when k < 60 then 'below_retention' else 'none' end as class from ev where event_type = 'error'",
    "approved_hashes": "select distinct repeat(md5(cast(k % 4 as varchar)), 2) as wasm_hash from ev where k >= 20",
    "address_shape": "select event_id, case when regexp_full_match(a, 'C[A-Z2-7]{55}') then 'contract' when regexp_full_match(a, 'G[A-Z2-7]{55}') then 'account' else 'invalid' end as shape from (select event_id, case when k < 40 then 'C' when k < 80 then 'G' else 'X' end || lpad(upper(translate(uid, '01890', 'ABCDE')), 55, 'A') as a from ev)",
    "url_host": "select event_id, concat('host', uid, '.example.org') as host, concat('https://user', case when k < 50 then ':***' else '' end, '@host', uid, '.example.org/p') as redacted from ev",
    "tip_mode": "select ledger_seq, processed_s - closed_s as age_s, processed_s - closed_s > 1200 as catching_up, processed_s - closed_s <= 30 as sweep_eligible from led",
    "discover": "select contract_id, ledger_seq, log_seq from disc",
    "asof_watchlist": "select raw_xdr, iv.contract_id is not null as is_tracked from raw left join iv on emitter = iv.contract_id and ledger_seq >= from_ledger and (to_ledger is null or ledger_seq < to_ledger)",
    "detect_events": "select contract_id as emitter, tx_hash, event_index, ledger_seq from facts where type = 'event'",
    "detect_deposits": "select contract_id, tx_hash, event_index, ledger_seq from facts where type = 'deposit'",
    "detect_facts": "select type, contract_id, event_kind, ledger_seq, closed_at, tx_hash, tx_index, event_index, raw_xdr from facts",
    "known_entries": "select contract_id, pos from entries semi join tracked using (contract_id)",
    "missing_from": "select contract_id from tracked anti join changes using (contract_id)",
    "append_removed": "select * from all_states",
    "guarded_states": "with r as (select distinct user_id % 7 as batch_id, uid as contract_id from ev), c as (select r.*, p.last_modified_ledger from r left join (select * from picked where cast(contract_id as bigint) % 7 >= 3) p using (contract_id)), g as (select batch_id, count(*) >= 10 and 2 * count(*) filter (last_modified_ledger is null) > count(*) as bad from c group by batch_id) select batch_id, contract_id, case when last_modified_ledger is null then 'removed' else 'updated' end as state_change_type, coalesce(last_modified_ledger, 0) as last_modified_ledger from c join g using (batch_id) where last_modified_ledger is not null or not bad",
    "refresh_targets": "with a as (select distinct event_id as cmd_seq, case when k < 10 then 'track' when k < 20 then 'refresh' else 'reseed' end as command, unnest(case when k < 20 then [uid] else [uid, cast(k as varchar)] end) as contract_id from ev where event_type = 'error' and k < 30) select cmd_seq, contract_id from a left join wnow using (contract_id) where command = 'track' or status = 'tracked' or (command = 'reseed' and coalesce(status <> 'tombstoned', true))",
    "active_entities": "select distinct ledger_seq, contract_id from facts",
    "ledger_progress": "select led.ledger_seq, (select count(*) from facts f where f.ledger_seq = led.ledger_seq) as events, (select count(*) from states s where s.ledger_seq = led.ledger_seq) as states, (select count(*) from iv where from_ledger <= led.ledger_seq and (to_ledger is null or to_ledger > led.ledger_seq)) as known_escrows, (select count(*) from gaps g where g.to_ledger < led.ledger_seq) as gaps from led",
    "sanitize_text": "select event_id, concat(event_type, '?A') as text from ev",
    "status": "select current_ledger, age as ledger_age_seconds, silent as seconds_since_last_ledger, tracked as known_escrows, events as events_published_total, n_states as state_changes_published_total, n_gaps as gaps_recorded, suppressed as suppressed_removals_total, not silent > 60 as ready, case when silent > 60 then concat('no ledger processed in ', silent, 's') else '' end as ready_reason, paused, cast(3600 as bigint) as uptime_seconds from stat",
    "removal_guard": "select batch_id, requested, missing, requested >= 10 and 2 * missing > requested as is_implausible from guard",
    "suppressed_total": "select suppressed from suppressed",
    "fetch_quantiles": "with o as (select ts_s, value / 100 as d from ev where event_type <> 'error'), w as (select (ts_s // 60 + i) * 60 as end_s, d from o, range(1, 11) r(i)) select end_s, round(quantile_cont(d, 0.5), 6) as p50, round(quantile_cont(d, 0.9), 6) as p90, round(quantile_cont(d, 0.99), 6) as p99, count(*) as n from w group by end_s",
    "fetch_quantile_panes": "with o as (select ts_s from ev where event_type <> 'error'), w as (select (ts_s // 60 + i) * 60 as end_s from o, range(1, 11) r(i)) select end_s, count(*) as n, true as near from w group by end_s",
    "rotation_batch": "select contract_id from tracked where contract_id > '120' order by contract_id limit 25",
    "watchlist_size": "select ledger_seq, cast(sum(d) over (order by ledger_seq) as bigint) as tracked from (select ledger_seq, sum(d) as d from (select from_ledger as ledger_seq, 1 as d from iv union all select to_ledger, -1 from iv where to_ledger is not null) group by ledger_seq)",
    "event_kind_counts": "select type, event_kind, count(*) as n from facts group by type, event_kind",
    "metrics_long": " union all ".join(f"select '{m}' as metric, '{kind}' as kind, 'testnet' as network, cast({x} as double) as value from stat" for kind, names in (("gauge", GAUGES), ("counter", COUNTERS)) for m, x in names.items()),
    "watchlist_fold": "select contract_id, effective, op, log_seq, status from fold",
    "watchlist_now": "select contract_id, status from wnow",
    "watchlist_intervals": "select contract_id, from_ledger, to_ledger from iv",
    "event_index": "select raw_xdr, tx_hash, tx_index, event_index from raw",
    "pick_state_entry": "select contract_id, is_data, pos, raw_xdr from picked",
    "continuity_breaks": "select b.ledger_seq, b.prev_hash, a.ledger_hash as expected from led b join led a on b.ledger_seq = a.ledger_seq + 1 where b.prev_hash <> a.ledger_hash",
    "history_view": f"select message_id, type, contract_id, cast({NOW_S} as bigint) as published_at from keys",
    "state_view": "select contract_id, state_change_type, ledger_seq, published_at from (select uid as contract_id, case when k < 5 then 'removed' else 'updated' end as state_change_type, ledger_seq, event_id as published_at, row_number() over (partition by uid order by ledger_seq desc, event_id desc) as r from ev where event_type in ('view', 'click')) where r = 1",
    "deferred_flush": "select distinct contract_id, flush_ledger from facts join (select a.ledger_seq, min(b.ledger_seq) as flush_ledger from tip a join tip b on b.ledger_seq >= a.ledger_seq and b.at_tip group by a.ledger_seq) using (ledger_seq)",
    "sweep_batches": "select contract_id, (rn - 1) // 20 as batch_id, (rn - 1) // 20 = (n - 1) // 20 as completes_pass from (select contract_id, row_number() over (order by contract_id) as rn, count(*) over () as n from tracked)",
    "pass_anchor": "select pass_no, start_ledger, lag(start_ledger, 1, 0) over (partition by g order by pass_no) as modified_since from (select ledger_seq // 50 as pass_no, ledger_seq as start_ledger, sum(case when ledger_seq % 400 = 0 then 1 else 0 end) over (order by ledger_seq) as g from led where ledger_seq % 50 = 0)",
    "stall_windows": "select from_s, to_s, to_s - from_s as silent_s from (select processed_s as from_s, lead(processed_s) over (order by processed_s) as to_s from led) where to_s - from_s > 1800",
    "pause_intervals": "select cmd_seq, from_s, to_s from pauses",
    "ordered_history": "select ledger_seq, tx_index, event_index, contract_id from facts order by ledger_seq, tx_index, event_index",
    "sorted_states": "select contract_id, state_change_type from states order by contract_id",
    "next_batch": "select contract_id, rn from (select contract_id, row_number() over (order by contract_id) as rn from tracked) where rn > 10 order by rn limit 25",
    "union_facts": f"select type, message_id, ledger_seq from keys union all select 'state', {STATE_ID}, ledger_seq from states union all select 'control', {GAP_ID}, to_ledger + 1 from gaps",
    "pending_union": "select contract_id from entries union select contract_id from facts",
    "watchlist_minus": "select distinct contract_id from entries where contract_id not in (select contract_id from wnow where status = 'tombstoned')",
    "replay_merge": f"select message_id, ledger_seq, cast(case when ledger_seq >= 3000 then {NOW_S} else {NOW_S} + 60 end as bigint) as published_at from keys where ledger_seq >= 2000",
    "gap_republish": f"select {GAP_ID} as message_id, to_ledger + 1 as ledger_seq, cast({NOW_S} as bigint) as published_at from gaps",
    "run_backfill": "select message_id, type, contract_id, ledger_seq from keys where ledger_seq between 2000 and 5000",
    "run_replay": "with w as (select contract_id from (select *, row_number() over (partition by contract_id order by effective desc, late desc, log_seq desc) as r from fold where effective <= 4000) where r = 1 and status = 'tracked') select concat(tx_hash, ':', event_index) as message_id, case when emitter in (select contract_id from w) then 'event' else 'deposit' end as type, case when emitter in (select contract_id from w) then emitter else recipient end as contract_id, ledger_seq from raw where ledger_seq between 100 and 8000 and (emitter in (select contract_id from w) or recipient in (select contract_id from w)) and (select min(ledger_seq) <= 100 and max(ledger_seq) >= 8000 from led)",
    "gap_detect": f"select start as from_ledger, oldest - 1 as to_ledger, 'rpc_retention' as reason, cast({NOW_S} as bigint) as detected_at from (select ledger_seq as start, case when ledger_seq % 11 = 0 then 9000 else 2000 end as oldest, 7000 as latest from led) where oldest <= latest and start <= latest + 60 and start < oldest",
    "tip_states": "with f as (select distinct contract_id, flush_ledger from facts join (select a.ledger_seq, min(b.ledger_seq) as flush_ledger from tip a join tip b on b.ledger_seq >= a.ledger_seq and b.at_tip group by a.ledger_seq) using (ledger_seq) where contract_id in (select contract_id from tracked)), j as (select f.*, c.state_change_type, c.last_modified_ledger from f left join changes c using (contract_id)), g as (select flush_ledger, count(*) >= 10 and 2 * count(*) filter (state_change_type is null) > count(*) as bad from j group by flush_ledger) select flush_ledger as ledger_seq, contract_id, coalesce(state_change_type, 'removed') as state_change_type, coalesce(last_modified_ledger, 0) as last_modified_ledger from j join g using (flush_ledger) where state_change_type is not null or not bad",
    "coverage_gaps": "select from_ledger, to_ledger from gaps",
    "remaining_gaps": "with g as (select ledger_seq as f, ledger_seq + 49 as t from led where ledger_seq % 100 = 0), m as (select f, n from g, lateral (select unnest(range(f, t + 1)) as n) where n not in (select ledger_seq from led)), i as (select f, n, n - row_number() over (partition by f order by n) as grp from m) select min(n) as from_ledger, max(n) as to_ledger from i group by f, grp",
    "chain_continuity": "select ledger_seq, lower(prev_hash) = '0' as continues from led where ledger_seq = (select min(ledger_seq) + 1 from led)",
}


def oracle_sql() -> dict[str, str]:
    views = ", ".join(f"{n} as ({q})" for n, q in VIEWS.items())
    return {n: f"with {views} select * from ({s})" for n, s in STATEMENTS.items()}
