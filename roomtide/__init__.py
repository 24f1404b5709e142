"""roomtide: occupancy and revenue analytics over calendar-availability panels, on Spark."""
