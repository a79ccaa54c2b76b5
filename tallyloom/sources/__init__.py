"""Reading and writing: schemas, scans, sinks, session set-up."""
