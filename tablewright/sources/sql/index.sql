-- Identifiers of the panel: every user with events in the window and every day of
-- the window. Each user row explodes its own days, so there is no join.
with users as (
    select distinct user_id as id
    from events
    where ts >= :start_date and ts < date_add(:end_date, 1)
)

select
    id,
    explode(sequence(:start_date, :end_date, interval 1 day)) as `date`
from users
