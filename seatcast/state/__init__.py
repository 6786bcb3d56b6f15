"""What the daily jobs keep between days, so that a new or replaced day costs that
day and not the whole history.

* ``totals``   additive totals over all stored days; a replaced day's old share is
               taken out and its new share added
* ``prices``   the totals behind the statistics: moments per event, counted prices
               per curve group, weekday sums; and the marts read from them
* ``history``  the per-event price history by day, continued from the last known
               row per event, with a rewind when an older day is replaced
"""
