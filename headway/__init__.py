"""Public-transit timetable feeds on Spark: cleaning, statistics, question/answer
datasets and answer scoring, all feeds in one plan, every key led by ``feed_id``."""
