"""The batch transforms over a stream of arriving documents."""
