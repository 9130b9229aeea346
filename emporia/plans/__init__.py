"""Session set-up and the jobs that compose operators into named tables."""
