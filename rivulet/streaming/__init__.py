from .stateful import (
    StateTable,
    Step,
    apply_per_batch,
    run_stateful,
    stream_assign_sequence,
    stream_check_state,
    stream_hold_release,
)
