"""Star tables, marts, audits and the jobs that write them."""
