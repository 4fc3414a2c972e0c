"""Star-schema builds, reports, checks and the jobs that chain them."""
