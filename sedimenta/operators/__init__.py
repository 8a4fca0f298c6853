"""DataFrame in, DataFrame out. Operators are lazy; none of them starts a job."""
