"""Parameters of the registered queries on the shared test tables.

The reference's limits are seconds-to-minutes on dense event streams; ``events``
holds one row every few minutes over 30 days, so time limits of the pattern and
join operators are scaled up (per SURVEY 7.2) while window sizes stay as in the
reference. The oracle SQL uses the same numbers.
"""

HOT_ITEMS = dict(size="1 hour", slide="5 minutes", n=5)
HOT_PAGES = dict(size="10 minutes", slide="5 seconds", n=3)
PV_WINDOW = "1 hour"
UV_RSD = 0.01
MARKETING = dict(size="1 hour", slide="5 seconds")
AD = dict(size="1 hour", slide="5 minutes", cap=1, period="1 day", zone_offset="+08:00", n=3)
LOGIN_PAIR_LIMIT = "6 hours"
LOGIN_NEXT_WITHIN = "9 hours"
LOGIN_TIMES3_WITHIN = "24 hours"
LOGIN_TIMER = dict(limit="6 hours", min_fails=2)
ORDER_WITHIN = "60 days"
TX = dict(lower="-3 hours", upper="5 hours")
#: After the deadline, orders wait so long for a late pay (streams).
ORDER_WAIT = "4000 days"
#: Arrival order of the stream queries: every tenth event comes 0 to 47 hours late; the
#: input is cut into so many micro-batches of equal arrival time.
DELAY = dict(every=10, factor=37, hours=48)
SLICES = 3
STREAM_BOUND = "48 hours"
LATE_BOUND = "3 hours"
LATE = dict(bound="1 second", size="10 minutes", slide="5 seconds", lateness="1 minute")
#: Re-firing windows: rows up to two days late correct the counts.
REFIRE = dict(size="10 minutes", slide="1 minute", bound="1 second", lateness="48 hours")
ASC_BOUND = "0 seconds"
