-- Daily features per user: money spent, clicks, an error flag (true or null)
-- and the event type that carried the most value that day.
select
    user_id as id,
    cast(ts as date) as `date`,
    round(sum(case when event_type = 'purchase' then value end), 2) as spend,
    count(case when event_type = 'click' then 1 end) as clicks,
    max(case when event_type = 'error' then true end) as err,
    max_by(event_type, struct(value, event_id)) as top_type
from events
where ts >= :start_date and ts < date_add(:end_date, 1)
group by user_id, cast(ts as date)
