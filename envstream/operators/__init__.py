"""DataFrame operators. Unless noted, each works on a batch table and on a stream."""
