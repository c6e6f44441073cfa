-- Target: number of events per user and day, sign-ups excluded.
select
    user_id as id,
    cast(ts as date) as `date`,
    count(case when event_type <> 'signup' then 1 end) as target
from events
where ts >= :start_date and ts < date_add(:end_date, 1)
group by user_id, cast(ts as date)
