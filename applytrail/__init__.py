"""Job-application tracking on Spark: mail and job-board exports in, one
reconciled application table and its funnel analytics out."""
