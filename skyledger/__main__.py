from skyledger.plans.cli import main

raise SystemExit(main())
